"""Secrets in texts: three fixed patterns, and a battery of randomness tests for tokens that no pattern names.

A candidate is a run of token characters. Its encoding is inferred (hex, base32, base36, base64), then tested: chi-squared
uniformity over cells of the alphabet, runs of equal cells, serial correlation of neighbours. The three p-values are
combined into one score, high for random tokens. The null distribution of the score comes from the words of all texts,
by length band; a candidate is reported if the Benjamini-Hochberg procedure within its band rejects "it is a word".
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices, texts_of, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: Lower ends of the length bands. Runs below LEAST only feed the null distribution.
BANDS = (12, 16, 20, 24, 32, 48, 72)
LEAST = 20
#: Scores are counted in steps of 1 / STEPS, between both ends.
STEPS, LOWEST, HIGHEST = 8, -160, 40
ENCODINGS = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), ("01234", "56789", "abcABC", "defDEF")),
    ("base32", re.compile(r"[A-Z2-7]+"), ("ABCDEFGH", "IJKLMNOP", "QRSTUVWX", "YZ234567")),
    ("base36", re.compile(r"[0-9a-z]+|[0-9A-Z]+"), ("0123456789", "abcdefghiABCDEFGHI", "jklmnopqrJKLMNOPQR", "stuvwxyzSTUVWXYZ")),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), ("0123456789+/_-=", "abcdefghijklm", "nopqrstuvwxyz", "ABCDEFGHIJKLM", "NOPQRSTUVWXYZ")),
)
#: Characters of each cell that the encoding uses, for the expected counts.
CELL_SIZES = {"hex": (5, 5, 3, 3), "base32": (8, 8, 8, 8), "base36": (10, 9, 9, 8), "base64": (12, 13, 13, 13, 13)}
_CELL_OF = {name: {c: i for i, cell in enumerate(cells) for c in cell} for name, _, cells in ENCODINGS}
SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string,"
    " base array<struct<start:int,kind:int,end:int>>,"
    " candidates array<struct<start:int,end:int,encoding:string,band:int,score:int>>, words array<struct<band:int,score:int,n:int>>"
)


@dataclass(frozen=True)
class Battery:
    """`rate`: share of false discoveries allowed among the candidates reported of one band."""

    rate: float = 0.05


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted. A match that is too short is consumed and dropped."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def upper_tail(z: float) -> float:
    """P(Z > z) of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity_z(counts: list[int], sizes: tuple[int, ...]) -> float:
    """Chi-squared of the cell counts against the cells' sizes, as a normal deviate (Wilson and Hilferty)."""
    n, total = sum(counts), sum(sizes)
    statistic = sum((c - n * s / total) ** 2 / (n * s / total) for c, s in zip(counts, sizes))
    k = len(sizes) - 1
    return ((statistic / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))


def runs_z(cells: list[int], sizes: tuple[int, ...]) -> float:
    """How far the number of runs of equal cells lies from what independent uniform characters give."""
    n, total = len(cells), sum(sizes)
    same = sum((s / total) ** 2 for s in sizes)
    triple = sum((s / total) ** 3 for s in sizes)
    variance = (n - 1) * same * (1 - same) + 2 * (n - 2) * (triple - same * same)
    changes = sum(a != b for a, b in zip(cells, cells[1:]))
    return abs(changes - (n - 1) * (1 - same)) / math.sqrt(variance)


def serial_z(cells: list[int]) -> float:
    """Correlation of neighbouring cells, as a normal deviate; constant cells are as far as can be."""
    n, mean = len(cells), sum(cells) / len(cells)
    spread = sum((c - mean) ** 2 for c in cells)
    if not spread:
        return math.sqrt(n)
    shared = sum((a - mean) * (b - mean) for a, b in zip(cells, cells[1:]))
    return abs(shared / spread + 1 / n) * math.sqrt(n)


def encoding_of(token: str) -> str:
    return next(name for name, pattern, _ in ENCODINGS if pattern.fullmatch(token))


def is_word(token: str) -> bool:
    """Letters only, in lower or upper case or capitalised: what natural text writes."""
    return token.isalpha() and (token.islower() or token.isupper() or token[1:].islower())


def score(token: str) -> tuple[str, int]:
    """The encoding, and the combined score in steps: Fisher's statistic of the three p-values, negated, per test."""
    name = "base64" if is_word(token) else encoding_of(token)
    cells = [_CELL_OF[name][c] for c in token]
    sizes = CELL_SIZES[name]
    counts = Counter(cells)
    tails = (
        upper_tail(uniformity_z([counts[i] for i in range(len(sizes))], sizes)),
        2 * upper_tail(runs_z(cells, sizes)),
        2 * upper_tail(serial_z(cells)),
    )
    combined = sum(math.log(max(p, 1e-12)) for p in tails)
    return name, max(LOWEST, min(HIGHEST, round(STEPS * combined / len(tails))))


def band_of(length: int) -> int:
    return sum(length >= lower for lower in BANDS) - 1


def scan(text: str) -> tuple[list, list, Counter]:
    """Base spans, candidates outside of them, and the words' counts by band and score."""
    spans = base_spans(text)
    taken, at, reach = sorted((s, e) for s, _, e in spans), 0, 0
    candidates, words = [], Counter()
    for m in CANDIDATE.finditer(text):
        token = m[0]
        while at < len(taken) and taken[at][0] < m.end():  # spans and candidates come in order: `reach` is where the former end
            reach, at = max(reach, taken[at][1]), at + 1
        if is_word(token):
            words[band_of(len(token)), score(token)[1]] += 1
        elif len(token) >= LEAST and reach <= m.start():
            if any(c.isdigit() for c in token):
                name, value = score(token)
                candidates.append((m.start(), m.end(), name, band_of(len(token)), value))
    return spans, candidates, words


def cutoffs(candidates: Counter, words: Counter, rate: float) -> dict[int, int]:
    """The least score reported in each band, from counts by (band, score). Bands that report nothing are absent.

    A candidate's p-value is (1 + words of at least its score) / (1 + words). Words of shorter bands join the null of a
    band: a long word is rarer, and a short one scores higher, so that p-values can only grow.
    """
    found = {}
    for band in range(band_of(LEAST), len(BANDS)):
        null = Counter()
        for (b, value), n in words.items():
            if b <= band:
                null[value] += n
        own = {value: n for (b, value), n in candidates.items() if b == band}
        total, so_far, tested = sum(null.values()), 0, sum(own.values())
        for value in sorted(own, reverse=True):
            so_far += own[value]
            p = (1 + sum(n for v, n in null.items() if v >= value)) / (1 + total)
            if p <= rate * so_far / tested:
                found[band] = value
    return found


def scanned(documents: DataFrame) -> DataFrame:
    """Rows of SCHEMA, one per document: what one reading of the text finds."""
    base = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    cand = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), ("band", pa.int32()), ("score", pa.int32())]))
    word = pa.list_(pa.struct([("band", pa.int32()), ("score", pa.int32()), ("n", pa.int32())]))

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(text) for text in texts_of(part)]
        counts = [[sum(k == kind for _, k, _ in spans) for spans, _, _ in found] for kind in range(3)]
        hashes = [hashlib.sha256(named(spans).encode()).hexdigest() for spans, _, _ in found]
        lists = [
            [[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans, _, _ in found],
            [[dict(zip(("start", "end", "encoding", "band", "score"), c)) for c in cs] for _, cs, _ in found],
            [[{"band": b, "score": v, "n": n} for (b, v), n in sorted(words.items())] for _, _, words in found],
        ]
        arrays = [pa.array(c, pa.int64()) for c in counts] + [pa.array(hashes)]
        arrays += [pa.array(values, kind) for values, kind in zip(lists, (base, cand, word))]
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "candidates", "words"]
        return pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *arrays], names)

    return map_slices(documents.select("doc_id", "text"), rows, SCHEMA)


def corpus_cutoffs(found: DataFrame, battery: Battery = Battery()) -> dict[int, int]:
    """Cutoffs from all documents. What comes to the driver are counts by band and score, at most a few thousand."""
    candidates = found.select(F.explode("candidates").alias("c")).groupBy("c.band", "c.score").agg(F.count(F.lit(1)).alias("n"))
    words = found.select(F.explode("words").alias("w")).groupBy("w.band", "w.score").agg(F.sum("w.n").alias("n"))
    counted = [Counter({(r["band"], r["score"]): r["n"] for r in frame.collect()}) for frame in (candidates, words)]
    return cutoffs(*counted, battery.rate)


def reported(found: DataFrame, cuts: dict[int, int]) -> DataFrame:
    """The result: base spans stay, candidates that reach their band's cutoff are added as `random_<encoding>`."""
    names = F.array(*[F.lit(k) for k in KINDS])
    as_base = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), names[b["kind"]].alias("name"), b["end"].alias("end")))
    keep = lambda c: F.coalesce(*[F.when(c["band"] == band, c["score"] >= cut) for band, cut in cuts.items()], F.lit(False))
    as_random = F.transform(
        F.filter("candidates", keep),
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), F.concat(F.lit("random_"), c["encoding"]).alias("name"), c["end"].alias("end")),
    )
    spans = F.array_sort(F.concat(as_base, as_random))
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string")))
    joined = F.array_join(texts, ",").alias("spans")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", joined, spans.alias("span_list"), F.size(as_random).alias("n_random"))


def random_secrets(documents: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """One row per row of `documents` (doc_id, text): counts of base spans, their digest, all spans as text and as list.

    Offsets are code points, ends exclusive. A null or empty text has no spans. Repeated rows give repeated rows and
    count as often in the null distribution; other columns are ignored; an empty table gives no rows. Texts are read
    once; what is found is written to the shared folder, and only counts are shuffled.
    """
    found = written(scanned(documents), "secrets")
    return reported(found, corpus_cutoffs(found, battery))


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping ones by one mark."""
    pieces, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redacted(documents: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """The same rows and columns; every span found is replaced in `text`, and `n_chars`, if there, is the new length.

    The spans of a text depend on the text and the cutoffs alone, so the second reading finds them again: no join.
    """
    cuts = corpus_cutoffs(written(scanned(documents), "secrets"), battery)

    def replace(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text in part.column("text").to_pylist():
            if text:
                base, candidates, _ = scan(text)
                extra = [(c[0], c[1]) for c in candidates if c[3] in cuts and c[4] >= cuts[c[3]]]
                text = redact(text, [(s, e) for s, _, e in base] + extra)
            texts.append(text)
        arrays = dict(zip(part.schema.names, part.columns))
        arrays["text"] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    changed = map_slices(documents, replace, documents.schema)
    return changed.withColumn("n_chars", F.char_length("text").cast(changed.schema["n_chars"].dataType)) if "n_chars" in changed.columns else changed

