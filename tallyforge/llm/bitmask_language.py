"""Language identification with bit-sliced Bloom filters: one lookup of an n-gram gives the set of all languages that hold it.

The filter is an array of bit masks, one bit per language. An n-gram's masks at its hash places, and-ed, name the
languages; counting each bit over a text's n-grams gives one hit rate per language, from which the rate of false
positives of that language's slice is taken out. The highest corrected rate decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import held_out, map_slices, texts_of, written

UNKNOWN = "und"
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, rate double, runner_up string"
SEPARATOR, SPACE = 0, 32
#: Slices of the texts are cut again where they hold more characters than this.
MOST_CHARS = 500_000


@dataclass(frozen=True)
class Filters:
    """`docs_per_language`: about so many labelled documents train each language, chosen by a hash of their ids.

    An n-gram is kept if it makes up `least_share` of its language's n-grams, so a language has at most 1 / least_share.
    """

    docs_per_language: int = 2000
    least_share: float = 1e-5
    bits: int = 20
    hashes: int = 3
    sizes: tuple[int, ...] = (3, 4)
    #: Below this corrected rate the pipeline takes a text for none of the languages.
    least_rate: float = 0.2


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: One array of masks per 64 languages.
    masks: tuple[np.ndarray, ...]
    #: False-positive rate of each language's slice.
    false_rates: tuple[float, ...]
    filters: Filters


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(texts: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text that each is in, and whether each text has a letter.

    Texts are lower-cased, what is no letter becomes one space, and each text has a space at both ends.
    """
    joined = " \x00 ".join(["", *(t.lower().replace("\x00", " ") for t in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[codes]
    codes = np.where(is_letter | (codes == SEPARATOR), codes, SPACE).astype(np.uint64)
    kept = np.ones(len(codes), bool)
    kept[1:] = ~((codes[1:] == SPACE) & (codes[:-1] == SPACE))
    has_letter = np.zeros(len(texts), bool)
    has_letter[np.cumsum(codes == SEPARATOR)[is_letter] - 1] = True
    codes = codes[kept]
    owner = np.cumsum(codes == SEPARATOR) - 1
    found, owners = [], []
    for n in sizes:
        if len(codes) < n:
            continue
        h, split = np.zeros(len(codes) - n + 1, np.uint64), np.zeros(len(codes) - n + 1, bool)
        for k in range(n):
            part = codes[k : len(codes) - n + 1 + k]
            h = (h + part + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            split |= part == SEPARATOR
        found.append(mixed(h[~split]))
        owners.append(owner[: len(h)][~split])
    order = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return np.concatenate(found) if found else np.zeros(0, np.uint64), order, has_letter


def places(h: np.ndarray, filters: Filters) -> list[np.ndarray]:
    """The hash places of each n-gram: disjoint parts of its 64 bits."""
    low = np.uint64((1 << filters.bits) - 1)
    return [((h >> np.uint64(k * filters.bits)) & low).astype(np.int64) for k in range(filters.hashes)]


def build(counted: dict[str, np.ndarray], order: list[str], filters: Filters) -> Model:
    """The filter of the given languages' n-gram hashes."""
    size = 1 << filters.bits
    masks = [np.zeros(size, np.uint64) for _ in range((len(order) + 63) // 64)]
    for i, language in enumerate(order):
        for place in places(counted[language], filters):
            masks[i // 64][place] |= np.uint64(1 << (i % 64))
    filled = [float(np.count_nonzero(masks[i // 64] & np.uint64(1 << (i % 64)))) / size for i in range(len(order))]
    return Model(tuple(order), tuple(masks), tuple(f**filters.hashes for f in filled), filters)


def rates(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Corrected hit rates, one row per text and one column per language, and whether each text has a letter."""
    h, owner, has_letter = grams(texts, model.filters.sizes)
    n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
    at = places(h, model.filters)
    out = np.zeros((len(texts), len(model.languages)))
    for word, masks in enumerate(model.masks):
        hit = masks[at[0]]
        for place in at[1:]:
            hit &= masks[place]
        for i in range(word * 64, min(len(model.languages), word * 64 + 64)):
            bit = (hit >> np.uint64(i % 64)) & np.uint64(1)
            share = np.bincount(owner, weights=bit.astype(np.float64), minlength=len(texts)) / n
            out[:, i] = np.clip((share - model.false_rates[i]) / (1 - model.false_rates[i]), 0, 1)
    return out, has_letter


def by_size(texts: list[str]) -> list[list[str]]:
    """The texts in lists of bounded length."""
    lists, size = [[]], 0
    for text in texts:
        if lists[-1] and size + len(text) > MOST_CHARS:
            lists.append([])
            size = 0
        lists[-1].append(text)
        size += len(text)
    return lists


def predict(texts: list[str], model: Model) -> list[tuple[str, float, float, str | None]]:
    """Language, score, corrected rate and runner-up of each text; `und` with score 0 where there is no letter.

    The score is the winner's share of the two highest rates. Equal rates go to the language with more training rows.
    """
    found = []
    for part in by_size(texts) if texts else []:
        if not model.languages:
            found += [(UNKNOWN, 0.0, 0.0, None)] * len(part)
            continue
        table, has_letter = rates(part, model)
        for row, known in zip(table, has_letter):
            if not known:
                found.append((UNKNOWN, 0.0, 0.0, None))
                continue
            best = int(np.argmax(row))
            others = np.delete(row, best)
            second = float(others.max()) if len(others) else 0.0
            runner_up = model.languages[int(np.argmax(others)) + (int(np.argmax(others)) >= best)] if len(others) else None
            top = float(row[best])
            found.append((model.languages[best], top / (top + second) if top else 1 / len(row), top, runner_up))
    return found


def train(documents: DataFrame, filters: Filters = Filters()) -> Model:
    """Learns from documents with a language whose ids are not held out: a sample by id hash, the same at every run.

    Only n-grams above the least share come to the driver: at most 1 / least_share per language.
    """
    labelled = documents.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(known, key=lambda x: (-known[x], x))
    if not order:
        return Model((), (), (), filters)
    steps = 1_000_000
    limits = F.create_map(*[F.lit(v) for x in order for v in (x, max(1, round(steps * filters.docs_per_language / known[x])))])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < limits[F.col("lang")])

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        languages, texts = part.column("lang").to_pylist(), texts_of(part)
        columns: tuple[list, list, list] = ([], [], [])
        for language in sorted(set(languages)):
            for some in by_size([t for x, t in zip(languages, texts) if x == language]):
                keys, n = np.unique(grams(some, filters.sizes)[0], return_counts=True)
                for column, values in zip(columns, ([language] * len(keys), keys.view(np.int64).tolist(), n.tolist())):
                    column += values
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "gram", "n"])

    counted = map_slices(sample, count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = written(counted, "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counted.join(F.broadcast(totals), "lang").filter(F.col("n") >= F.col("total") * filters.least_share)
    found = frequent.select("lang", "gram").toPandas()
    hashes = {x: found.gram[found.lang == x].to_numpy(np.int64).view(np.uint64) for x in order}
    return build(hashes, order, filters)


def bitmask_language(documents: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """One row per row of `documents` (doc_id, text, lang): prediction and score.

    The prediction uses the text alone. A null text, or one without a letter, is `und` with score 0; so is every text
    if no row may be learnt from. Repeated rows give repeated rows; ties go to the language with more training rows,
    then to the lesser name; other columns are ignored; an empty table gives no rows. Nothing but counts is shuffled.
    """
    model = train(documents, filters)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def decide(part: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*predict(texts_of(part), shared.value)))
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.string())
        columns = [part.column("doc_id"), part.column("held_out"), *[pa.array(c, k) for c, k in zip(found, kinds)]]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out().alias("held_out"))
    return map_slices(rows, decide, SCHEMA)


def in_known_language(documents: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """The documents whose language is one of the learnt ones, all columns kept."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, filters))

    def keep(part: pa.RecordBatch) -> pa.RecordBatch:
        found = predict(texts_of(part), shared.value)
        return part.filter(pa.array([x != UNKNOWN and rate >= filters.least_rate for x, _, rate, _ in found], pa.bool_()))

    return map_slices(documents, keep, documents.schema)
