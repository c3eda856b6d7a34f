"""Byte-level BPE over overlapping chunks, and decoding by concatenation of the tokens' bytes.

A text is cut into chunks that overlap, and each is pre-tokenised from its own start. Where the boundaries of a chunk meet
those of its predecessor inside their overlap, both go on alike, so the text is cut there. Where they don't meet, the walk
from the last known boundary goes on to the next overlap. Pieces are encoded on their own and their ids joined.

Texts of a size that one task handles are chunked in the task that reads them. Longer ones are dealt out in large chunks
first; their pieces are encoded wherever they are, by small chunks again.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices, tasks, texts_of
from tallyforge.llm.unit_encoder import vocabulary

#: Characters of the longest pre-token that is spelt out in the pattern, such as 'll.
LONGEST_MARK = 3
SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
CHUNKS = "doc_id bigint, text_key string, copies bigint, i int, at bigint, chunk string, head array<bigint>, tail array<bigint>"
PIECES = "doc_id bigint, text_key string, copies bigint, piece bigint, n_tokens bigint, ids binary, raw binary"


@dataclass(frozen=True)
class Chunking:
    """`chunk` and `overlap`: characters of the chunks that are dealt over tasks; `small` and `margin`: those inside a task."""

    chunk: int = 65_536
    overlap: int = 2_048
    small: int = 2_048
    margin: int = 192
    ranks: str = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=2)
def encoding(path: str):
    """The library's encoding of the rank file, and the bytes of every id. One per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    made = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made, {rank: token for token, rank in ranks.items()}


@lru_cache(maxsize=1)
def pre_tokens():
    """The splitting pattern, with white space as Unicode has it."""
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def boundaries(text: str, start: int, stop: int) -> list[int]:
    """Where pre-tokens begin if the text began at `start`, but for the last characters that only what follows decides on."""
    sure = stop - LONGEST_MARK if stop < len(text) else stop
    return [start + m.start() for m in pre_tokens().finditer(text[start:stop]) if start + m.start() <= sure]


def pieces(text: str, how: Chunking) -> list[str]:
    """The text cut at true boundaries of pre-tokens, once per chunk where two chunks agree on one.

    Blanks are pre-tokens that look at what follows, so no cut is made behind one. `known` are the true boundaries up to the end of the chunk before: those of the first chunk are, and those of a later
    one are from the first boundary on that it shares with them.
    """
    if len(text) <= how.small:
        return [text] if text else []
    cuts, known = [0], boundaries(text, 0, how.small + how.margin)
    for at in range(how.small, len(text), how.small):
        own = boundaries(text, at, at + how.small + how.margin)
        behind = {b for b in known[bisect_left(known, at) :] if not text[b - 1].isspace()}
        if (met := next((b for b in own if b in behind), None)) is not None:
            cuts.append(met)
            known = own[bisect_left(own, met) :]
        else:
            known = boundaries(text, known[-1], at + how.small + how.margin) or known[-1:]
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)]) if a < b]


def encode(text: str, path: str, how: Chunking) -> tuple[bytes, bytes, int]:
    """Ids as little-endian unsigned 32-bit, the bytes they decode to, and how many there are."""
    made, tokens = encoding(path)
    ids = [i for piece in pieces(text, how) for i in made.encode_ordinary(piece)]
    return np.array(ids, "<u4").tobytes(), b"".join([tokens[i] for i in ids]), len(ids)


def joints(chunk: str, at: int, size: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries that the chunk's own pre-tokens have in its first `overlap` characters, and after its first `size`.

    The end of the last pre-token is none of them, for the text may go on behind the chunk, and neither are those behind a
    blank, which would be another pre-token if the text ended there.
    """
    starts = [m.start() for m in pre_tokens().finditer(chunk)]
    return [at + s for s in starts if s < overlap], [at + s for s in starts if size <= s <= len(chunk) - LONGEST_MARK and not chunk[s - 1].isspace()]


def chunked(long: DataFrame, how: Chunking) -> DataFrame:
    """Rows of CHUNKS but for the joints, from rows (doc_id, text, copies)."""

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, text, copies in zip(part.column("doc_id").to_pylist(), texts_of(part), part.column("copies").to_pylist()):
            key = hashlib.sha256(text.encode()).hexdigest()
            for i, at in enumerate(range(0, len(text), how.chunk)):
                rows.append((doc_id, key, copies, i, at, text[at : at + how.chunk + how.overlap]))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "text_key", "copies", "i", "at", "chunk"])

    return map_slices(long, cut, CHUNKS.split(", head")[0])


def pre_tokenised(chunks: DataFrame, how: Chunking) -> DataFrame:
    def mark(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [joints(c, at, how.chunk, how.overlap) for c, at in zip(part.column("chunk").to_pylist(), part.column("at").to_pylist())]
        head, tail = ([f[k] for f in found] for k in (0, 1))
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (head, tail)]
        return pa.RecordBatch.from_arrays([*part.columns, *lists], [*part.schema.names, "head", "tail"])

    return map_slices(chunks, mark, CHUNKS)


def stitched(chunks: DataFrame, how: Chunking) -> DataFrame:
    """Pieces of the long texts (doc_id, text_key, copies, piece, part): cut where all joints so far were found."""
    key = ["doc_id", "text_key"]
    ordered = W.partitionBy(*key).orderBy("i")
    met = F.array_min(F.array_intersect(F.lag("tail").over(ordered), F.col("head")))
    joined = chunks.withColumn("met", met)
    missing = F.sum(F.when((F.col("i") > 0) & F.col("met").isNull(), 1).otherwise(0)).over(ordered)
    joined = joined.withColumn("cut", F.when(missing == 0, F.col("met")))
    piece = F.sum(F.when(F.col("cut").isNotNull(), 1).otherwise(0)).over(ordered)
    start = F.coalesce(F.col("cut"), F.col("at"))
    end = F.coalesce(F.lead("cut").over(ordered), F.col("at") + how.chunk)
    part = F.substring(F.col("chunk"), (start - F.col("at") + 1).cast("int"), (end - start).cast("int"))
    parts = joined.select(*key, "copies", "i", piece.alias("piece"), part.alias("part"))
    in_order = F.array_sort(F.collect_list(F.struct("i", "part")))
    return parts.groupBy(*key, "copies", "piece").agg(F.array_join(F.transform(in_order, lambda x: x["part"]), "").alias("text"))


def encoded(pieces: DataFrame, how: Chunking) -> DataFrame:
    def ids_of(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [encode(text, vocabulary(how.ranks), how) for text in texts_of(part)]
        columns = [pa.array([f[2] for f in found], pa.int64()), *[pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)]]
        names = ["doc_id", "text_key", "copies", "piece"]
        return pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *columns], [*names, "n_tokens", "ids", "raw"])

    return map_slices(pieces, ids_of, PIECES)


def concatenated(parts: Column, name: str) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda x, y: F.concat(x, y[name]))


def chunk_bpe(documents: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """Number and sha256 of every text's ids, and the sha256 of the bytes that they decode to.

    A null text is an empty one: no ids. Repeated rows are encoded once if long, and returned as often as they occur;
    null doc_ids and ties need no rule; other columns are ignored; an empty table gives no rows. All texts are encoded by
    overlapping chunks: in the task that reads them, and very long ones spread over the tasks by large chunks first.
    """
    documents = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def digest(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [encode(text, vocabulary(how.ranks), how) for text in texts_of(part)]
        hashes = [pa.array([hashlib.sha256(f[k]).hexdigest() for f in found], pa.string()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([f[2] for f in found], pa.int64()), *hashes], [f.split()[0] for f in SCHEMA.split(", ")]
        )

    is_long = F.coalesce(F.char_length("text") > how.chunk, F.lit(False))
    short = map_slices(documents.filter(~is_long), digest, SCHEMA)
    long = documents.filter(is_long).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    spread = chunked(long, how).repartition(tasks(documents.sparkSession), "text_key", "i")
    pieces = encoded(stitched(pre_tokenised(spread, how), how).repartition(tasks(documents.sparkSession), "text_key", "piece"), how)
    whole = pieces.groupBy("doc_id", "text_key", "copies").agg(
        F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("piece", "ids", "raw"))).alias("parts")
    )
    whole = whole.select(
        "doc_id",
        "n_tokens",
        F.sha2(concatenated(F.col("parts"), "ids"), 256).alias("ids_sha256"),
        F.sha2(concatenated(F.col("parts"), "raw"), 256).alias("decoded_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    return short.unionByName(whole.drop("copy"))
