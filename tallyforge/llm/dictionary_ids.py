"""Token ids in binary volumes: every document is compressed by itself with a zstandard dictionary that all share.

A volume is one Parquet row: a body of compressed frames one after another, and an offset index with one entry per
document. It carries the hash of the dictionary it needs; a reader refuses any other. A document is read by slicing its
frame out of the body, without touching its neighbours.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.llm.common import slices, tasks, texts_of
from tallyforge.llm.unit_encoder import encoder, vocabulary

VOLUMES = (
    "part int, volume int, first_doc bigint, last_doc bigint, n_docs bigint, n_tokens bigint, dictionary_hash string,"
    " body binary, index binary"
)
#: One entry of the index.
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u4"), ("length", "<u4"), ("tokens", "<u4")])
#: Places that hashes are dealt to, to choose a share of them.
PLACES = 1_000_000_000
RESULT = "doc_id bigint, part int, volume int, before bigint, n_tokens bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Format:
    """About `sample_docs` documents chosen by a hash, up to `sample_bytes` characters of each, train the dictionary: that
    bounds what the driver gets. Ids are stored in 16 bits, so the vocabulary may hold 65,536."""

    end_id: int = 2
    tokenizer: str = "byte_bpe_50k.json"
    sample_docs: int = 512
    sample_bytes: int = 16_384
    dictionary_bytes: int = 65_536
    level: int = 3
    volume_bytes: int = 4_000_000


def serialized(ids: bytes) -> bytes:
    """16-bit little-endian, from 32-bit."""
    wide = np.frombuffer(ids, "<u4")
    if wide.size and int(wide.max()) > 65_535:
        raise ValueError("an id does not fit into 16 bits")
    return wide.astype("<u2").tobytes()


def train(documents: DataFrame, how: Format = Format()) -> bytes:
    """A dictionary from the serialized ids of a bounded sample. Few documents or equal ones give a raw-content one.

    The share of hashes that are sampled follows from the number of documents, and tasks cut the texts before they send
    them. Copies of one row have one hash, so the sample is limited too; which of its rows are left out then is open.
    """
    rows = documents.filter("text IS NOT NULL").select("doc_id", F.substring("text", 1, how.sample_bytes).alias("text"))
    share = min(1.0, how.sample_docs / max(1, rows.count()))
    place = F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(PLACES))
    sample = rows.filter(place < math.ceil(share * PLACES)).select("text").limit(2 * how.sample_docs)
    texts = sorted(r.text for r in sample.collect())
    parts = [serialized(ids) for ids in encoder(vocabulary(how.tokenizer)).encode(texts)]
    parts = [p[i : i + 2048] for p in parts for i in range(0, len(p), 2048)]
    try:
        return zstandard.train_dictionary(how.dictionary_bytes, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-how.dictionary_bytes :] or b"\x00" * 8


def dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def dictionary_hash(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def write_ids(documents: DataFrame, path: str, how: Format = Format()) -> None:
    """Volumes in ascending order of doc_id under `path`/volumes, the dictionary under `path`/dictionary.

    Rows are dealt by ranges of doc_id and sorted before they are encoded; null doc_ids come first. Rows of one doc_id, or
    without any, are dealt on by the beginnings of their texts. A null text is empty. Tasks hold one volume at a time.
    """
    spark = documents.sparkSession
    raw = train(documents, how)
    name = dictionary_hash(raw)
    spark.createDataFrame([(name, bytearray(raw))], "dictionary_hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, volume = TaskContext.get().partitionId(), 0
        encode, end = encoder(vocabulary(how.tokenizer)).encode, np.array([how.end_id], "<u4").tobytes()
        frames = zstandard.ZstdCompressor(level=how.level, dict_data=dictionary(raw), write_checksum=True)
        body, entries, size = [], [], 0

        def closed() -> pa.RecordBatch:
            docs = [e[0] for e in entries if not e[1]] or [None]
            row = [part, volume, docs[0], docs[-1], len(entries), sum(e[4] for e in entries), name, b"".join(body), np.array(entries, ENTRY).tobytes()]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], [f.split()[0] for f in VOLUMES.split(", ")])

        for rows in slices(batches, 256):
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encode(texts_of(rows))):
                frame = frames.compress(serialized(ids + end))
                entries.append((doc_id or 0, doc_id is None, size, len(frame), len(ids) // 4 + 1))
                body.append(frame)
                size += len(frame)
                if size >= how.volume_bytes:
                    yield closed()
                    body, entries, size, volume = [], [], 0, volume + 1
        if entries:
            yield closed()

    ordered = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64(F.substring("text", 1, 256)).alias("tie"))
    ordered = ordered.repartitionByRange(tasks(spark), "doc_id", "tie").sortWithinPartitions("doc_id").select("doc_id", "text")
    ordered.mapInArrow(run, VOLUMES).write.option("compression", "none").parquet(f"{path}/volumes")


def open_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    return row.dictionary_hash, bytes(row.dictionary)


def frames_of(index: bytes, body: bytes, raw: bytes, wanted: set | None = None) -> Iterator[tuple]:
    """doc_id, ids before it in the volume, and its ids (32-bit little-endian). Skips frames of other documents."""
    reader, before = zstandard.ZstdDecompressor(dict_data=dictionary(raw)), 0
    for doc_id, null, offset, length, n_tokens in np.frombuffer(index, ENTRY).tolist():
        doc_id = None if null else doc_id
        if wanted is None or doc_id in wanted:
            ids = np.frombuffer(reader.decompress(body[offset : offset + length]), "<u2").astype("<u4")
            if len(ids) != n_tokens:
                raise ValueError(f"document {doc_id}: {len(ids)} ids, the index has {n_tokens}")
            yield doc_id, before, ids.tobytes()
        before += n_tokens


def digests(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold: doc_id, start, n_tokens, ids_crc32 of every document."""
    name, raw = open_dictionary(spark, path)
    volumes = spark.read.parquet(f"{path}/volumes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for part in slices(batches, 1) for r in part.to_pylist()):
            if row["dictionary_hash"] != name:
                raise ValueError("the volume needs another dictionary")
            found = [(d, row["part"], row["volume"], b, len(ids) // 4, zlib.crc32(ids)) for d, b, ids in frames_of(row["index"], row["body"], raw)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], [f.split()[0] for f in RESULT.split(", ")])

    parts = volumes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    first = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = W.partitionBy("part").orderBy("volume").rowsBetween(W.unboundedPreceding, -1)
    starts = volumes.select("part", "volume", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("skipped"))
    starts = starts.join(first, "part")
    found = volumes.mapInArrow(run, RESULT).join(starts, ["part", "volume"])
    return found.select("doc_id", (F.col("first") + F.col("skipped") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "part", "volume")


def read_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of the named documents: only volumes whose range holds one are read, only their frames are decompressed."""
    name, raw = open_dictionary(spark, path)
    wanted = set(doc_ids)
    near = F.lit(False)
    for d in wanted:
        near = near | F.lit(d).between(F.col("first_doc"), F.col("last_doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for part in slices(batches, 1) for r in part.to_pylist()):
            if row["dictionary_hash"] != name:
                raise ValueError("the volume needs another dictionary")
            found = [(d, np.frombuffer(ids, "<u4").tolist()) for d, _, ids in frames_of(row["index"], row["body"], raw, wanted)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return spark.read.parquet(f"{path}/volumes").filter(near).mapInArrow(run, "doc_id bigint, ids array<bigint>")


def dictionary_ids(documents: DataFrame, path: str, how: Format = Format()) -> DataFrame:
    """Write all documents under `path` and return what the files hold of each.

    Repeated rows are written one by one, in any order among equal doc_ids; an empty table gives no volumes and no rows;
    other columns are ignored.
    """
    write_ids(documents, path, how)
    return digests(documents.sparkSession, path)
