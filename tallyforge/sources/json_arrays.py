"""Records of JSON array files, each file read by as many tasks as it has blocks.

The text source cuts a file behind every closing brace, wherever in the file a task begins. Whether a brace ends a record
depends on all text before it, but on little of that: the parity of the quotes tells whether a block begins inside a
string, and the brackets outside strings tell how deep it begins. Every block sums up both, the depth once for each way it
may begin; a running sum over the few blocks of a file then tells how each of them does begin. With that the task that reads
a block cuts its records out as the text passes, so that no text is sorted or shuffled but that of records which reach over
a block's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BLOCK = ["file", "block"]
#: Pieces looked at together.
_ROWS = 2048
_QUOTE, _BACKSLASH, _BRACE = 1, 2, 5
_KIND = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b'"', b"\\", b"[{", b"]", b"}"), start=1):
    _KIND[list(_bytes)] = _kind
_CHANGE = np.array([0, 0, 0, 1, -1, -1], np.int64)
_FRAGMENTS = "file string, block bigint, nth int, text string, depth bigint, begins boolean, last boolean"


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per object of the array in every file, column `raw_data`, its text as it is in the file.

    A file that is not one whole array of objects raises when the query runs: truncated or empty, with a damaged object,
    or with anything but a comma and blanks between two objects. A compressed file is one block. Files are read three
    times, for the sums over blocks, for the records within a block and for those that reach over a block's end; only
    these are shuffled. Every task gets the beginnings of all blocks, a row for each.
    """
    pieces = _pieces(spark, path)
    blocks = _blocks(pieces)
    records = _fragments(pieces, blocks, whole=True).select("file", "text", "depth", "last")
    records = records.unionByName(_across_blocks(_fragments(pieces, blocks, whole=False)))
    return _checked(records).unionByName(_empty_files(spark, path))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, piece), each piece with the brace behind it. A block is read by one task, its pieces in their order.

    A file's last piece has no brace in the file; it is taken off again where that piece is used.
    """
    found = spark.read.option("lineSep", "}").text(path)
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    return found.select(*place, F.concat("value", F.lit("}")).alias("piece"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, int]]:
    """Bytes of successive pieces of one block, where the last of them begins, and the block's columns."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            columns = part.select([c for c in part.schema.names if c != "piece"])
            piece = part.column("piece").cast(pa.large_binary())
            offsets = np.frombuffer(piece.buffers()[1], np.int64)[piece.offset : piece.offset + len(piece) + 1]
            data = np.frombuffer(piece.buffers()[2], np.uint8)
            new = np.zeros(len(piece), bool)
            for name in _BLOCK:
                values = part.column(name)
                new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
            ends = [*np.flatnonzero(new).tolist(), len(piece)]
            for low, high in zip([0, *ends[:-1]], ends):
                yield columns.slice(low, 1).to_pylist()[0], data[offsets[low] : offsets[high]], int(offsets[high - 1] - offsets[low])


def _marks(data: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and brackets that no backslash protects, their kinds, and which are behind an odd number of quotes.

    A piece's closing brace is protected by nothing; `inside` counts as a quote in front.
    """
    at = np.flatnonzero(_KIND[data])
    kind = _KIND[data[at]]
    back = at[kind == _BACKSLASH]
    if len(back):
        first = np.diff(back, prepend=-2) != 1
        length = np.diff(np.append(np.flatnonzero(first), len(back)))
        behind = (back[first] + length)[length % 2 == 1]
        protected = np.zeros(len(data), bool)
        protected[behind[_KIND[data[behind]] != _BRACE]] = True
        keep = (kind != _BACKSLASH) & ~protected[at]
        at, kind = at[keep], kind[keep]
    return at, kind, np.bitwise_xor.accumulate(kind == _QUOTE) ^ bool(inside)


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block its quotes, modulo 2, and the brackets it opens less those it closes if it begins outside or inside a string."""
    now: dict = {}
    for block, data, _ in _stretches(batches):
        if now and any(now[c] != block[c] for c in _BLOCK):
            yield pa.RecordBatch.from_pylist([now])
            now = {}
        now = now or block | {"quotes": 0, "out": 0, "into": 0}
        _, kind, odd = _marks(data, now["quotes"])
        change = _CHANGE[kind]
        now["into"] += int(change[odd].sum())
        now["out"] += int(change[~odd].sum())
        now["quotes"] = int(odd[-1])
    if now:
        yield pa.RecordBatch.from_pylist([now])


def _blocks(pieces: DataFrame) -> DataFrame:
    """(file, block, inside_at, depth_at, last_block): how each block begins, from the sums over those before it."""
    sums = pieces.mapInArrow(_block_sums, "file string, block bigint, quotes bigint, out bigint, into bigint")
    order = W.partitionBy("file").orderBy("block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    inside = sums.withColumn("inside_at", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("inside_at") == 0, F.col("out")).otherwise(F.col("into"))
    depth, last = F.coalesce(F.sum(change).over(before), F.lit(0)), F.lead("block").over(order).isNull()
    return inside.select(*_BLOCK, "inside_at", depth.alias("depth_at"), last.alias("last_block"))


class _Cutter:
    """Cuts one block behind the braces that close a record; the piece before the block's end is held back until that is known."""

    def __init__(self, block: dict, whole: bool):
        self.block, self.whole = block, whole
        self.inside, self.depth = block["inside_at"], block["depth_at"]
        self.nth, self.held, self.open = 0, None, []
        self.open_depth, self.begins = self.depth, self.depth <= 1 and not self.inside

    def rows(self, texts: pa.Array, depth: list[int], begins: list[bool], last: bool = False) -> pa.RecordBatch:
        n = len(texts)
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
        arrays = [same(self.block["file"], pa.string()), same(self.block["block"], pa.int64()), same(min(self.nth, 1), pa.int32())]
        arrays += [texts, pa.array(depth, pa.int64()), pa.array(begins, pa.bool_()), same(last, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _FRAGMENTS.split(", ")])

    def one(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What is open as a fragment that nothing closes here."""
        if self.whole == (self.begins and last):
            yield self.rows(pa.array([b"".join(self.open)], pa.binary()).view(pa.string()), [self.open_depth], [self.begins], last)

    def cut(self, data: np.ndarray) -> Iterator[pa.RecordBatch]:
        at, kind, odd = _marks(data, self.inside)
        depth = self.depth + np.cumsum(np.where(odd, 0, _CHANGE[kind]))
        ends = at[(kind == _BRACE) & ~odd & (depth == 1)] + 1
        self.inside, self.depth = int(odd[-1]), int(depth[-1])
        if not len(ends):
            self.open.append(data.tobytes())
            return
        done = b"".join([*self.open, data[: ends[-1]]])
        offsets = np.append(0, ends + (len(done) - ends[-1]))
        n = len(ends) if self.whole else 1
        skip = int(self.whole != self.begins)
        if n > skip:
            buffers = [None, pa.py_buffer(offsets[skip : n + 1].astype(np.int32)), pa.py_buffer(done)]
            texts = pa.Array.from_buffers(pa.string(), n - skip, buffers)
            yield self.rows(texts, ([self.open_depth] + [1] * (n - 1))[skip:], ([self.begins] + [True] * (n - 1))[skip:])
        self.nth += len(ends)
        self.open, self.open_depth, self.begins = [data[ends[-1] :].tobytes()], 1, True

    def feed(self, data: np.ndarray, last_piece: int) -> Iterator[pa.RecordBatch]:
        if self.held is not None:
            yield from self.cut(self.held)
        if last_piece:
            yield from self.cut(data[:last_piece])
        self.held = data[last_piece:].copy()

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.block["last_block"]:
            self.open.append(self.held[:-1].tobytes())
            yield from self.one(last=True)
        else:
            yield from self.cut(self.held)
            if any(self.open):
                yield from self.one()


def _fragments(pieces: DataFrame, blocks: DataFrame, whole: bool) -> DataFrame:
    """Text of one block that belongs to one record: whether it `begins` here, the depth in front. Either the whole records,
    or the two others at most that a block has, of which `nth` tells the order.

    What stands behind the last record of a file is a fragment of its own, marked `last`.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for block, data, last_piece in _stretches(batches):
            if now is None or any(now.block[c] != block[c] for c in _BLOCK):
                if now is not None:
                    yield from now.end()
                now = _Cutter(block, whole)
            yield from now.feed(data, last_piece)
        if now is not None:
            yield from now.end()

    return pieces.join(F.broadcast(blocks), _BLOCK).mapInArrow(cut, _FRAGMENTS)


def _joined(parts: str) -> Column:
    return F.array_join(F.transform(parts, lambda part: part["text"]), "")


def _across_blocks(fragments: DataFrame) -> DataFrame:
    """The records that reach over a block's end, from the two unfinished fragments at most that each block has."""
    order = W.partitionBy("file").orderBy("block", "nth")
    numbered = fragments.withColumn("record", F.sum(F.col("begins").cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "nth", "text"))).alias("parts")
    joined = numbered.groupBy("file", "record").agg(parts, F.min_by("depth", F.struct("block", "nth")).alias("depth"), F.bool_or("last").alias("last"))
    return joined.select("file", _joined("parts").alias("text"), "depth", "last")


def _checked(records: DataFrame) -> DataFrame:
    """The records' own text; anything else than records, commas and the array's brackets raises."""
    tail = ((F.col("depth") == 1) & F.col("text").rlike(r"^\s*\]\s*$")) | ((F.col("depth") == 0) & F.col("text").rlike(r"^\s*\[\s*\]\s*$"))
    front = F.when(F.col("depth") == 0, F.col("text").rlike(r"^\s*\[\s*\{")).otherwise(F.col("text").rlike(r"^\s*,\s*\{"))
    raw = F.regexp_replace("text", r"^\s*[\[,]\s*", "")
    sound = F.when(F.col("last"), tail).otherwise(front & F.try_parse_json(raw).isNotNull())
    damaged = F.raise_error(F.concat(F.lit("not a whole JSON array of objects: "), F.col("file")))
    keep = F.when(F.coalesce(sound, F.lit(False)), ~F.col("last")).otherwise(damaged.cast("boolean"))
    return records.filter(keep).select(raw.alias("raw_data"))


def _empty_files(spark: SparkSession, path: str) -> DataFrame:
    """No rows. A file without a byte raises: it is in the listing, but no source reads anything of it."""
    files = spark.read.format("binaryFile").load(path)
    one_slash = [F.regexp_replace(c, "^([a-zA-Z0-9+.-]+):/+", "$1:/").alias("file") for c in ("name", "_metadata.file_path")]
    listed = spark.createDataFrame([(name,) for name in files.inputFiles()], "name string").select(one_slash[0])
    found = listed.join(files.select(one_slash[1], F.lit(True).alias("found")), "file", "left")
    damaged = F.raise_error(F.concat(F.lit("not a whole JSON array of objects: "), F.col("file")))
    return found.filter(F.when(F.col("found").isNull(), damaged.cast("boolean")).otherwise(False)).select(F.col("file").alias("raw_data"))
