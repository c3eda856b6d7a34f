"""Exact Jaccard self-join of word-shingle sets with parity sketches.

XOR is the parity of a set: shingles that two documents share cancel out. A document's shingles are dealt to parts by
hash, and every part is reduced to the XOR of its shingles' hashes. The number of parts is larger than the symmetric
difference that a link allows in its band of sizes, so by the pigeonhole two linked documents have equal XORs in at least
one part that is not empty, and meet there. A second sketch flips one bit per shingle: the Hamming distance of two such
sketches is at most the symmetric difference, so pairs that are farther apart are dropped unseen. The rest is verified
with the shingles themselves.

Documents that share a part meet in the star of the part's least document, once however many parts they share, and all
pairs of a star are compared by their sketches. Only what joins components is verified: first a spanning forest of each
star's near pairs, the nearest first; then another one of the pairs whose ends are still in different components; at last
all pairs that are left between components. Verified pairs so grow with the documents in stars, not with their square, but
for pairs that are near and do not link.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.llm.bitmask_language import mixed
from tallyforge.llm.common import map_slices, slices, tasks, texts_of, written
from tallyforge.llm.components import components

WORDS = 5
KEYS, MEMBERS, DOCUMENTS = 0, 1, 2
PACKED = "slice int, what int, x binary, y binary, doc_id bigint, n bigint, node bigint, sketch binary"
#: A task hands over its keys when it has so many, or so many documents.
MOST_KEYS, MOST_DOCUMENTS = 2_000_000, 60_000
#: From so many documents of one hand-over on, a key's documents bypass its slice: only the first goes there.
HOT = 64
#: Stars with more documents than this are compared in blocks of about this size.
BLOCK = 2048
#: Sketches compared at a time, and near pairs that a task holds before it looks for a forest of them.
AT_ONCE, MOST_PAIRS = 1 << 16, 1 << 20
#: Parts with fewer documents than this are never left out.
FREQUENT = 4
#: Rounds in which only forests of the near pairs are verified, before all that are left.
FOREST_ROUNDS = 2
#: Places of the filter that decides which texts are read again: its size is fixed, and it lets few others through.
FILTER_PLACES, FILTER_ROW = 1 << 23, 1 << 15
NEAR = "bin bigint, forest boolean, x binary, y binary"
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\v\f\r")] = True
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Join:
    """Documents link if 100 * intersection >= percent * union."""

    percent: int = 80

    def difference(self, total: int) -> int:
        """The largest symmetric difference of two linked sets whose sizes add up to `total`."""
        return total * (100 - self.percent) // (100 + self.percent)


@lru_cache(maxsize=1)
def powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, 0x100000001B3, np.uint64), out=out[1:])
    return out


def shingles(text: str) -> np.ndarray:
    """The text's set of shingles as sorted 64-bit hashes. Words are lower-cased in ASCII only."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    solid = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0, append=0))
    lengths = edge[1::2] - edge[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    firsts = np.cumsum(lengths) - lengths
    size = 1 << max(6, int(lengths.max()).bit_length())
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    terms = (data[solid].astype(np.uint64) + _U(1)) * powers(size)[place]
    words = mixed(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64) * _BASE)
    width = min(WORDS, len(words))
    h = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        h = (h ^ words[k : len(words) - width + 1 + k]) * _BASE
        h ^= h >> _U(29)
    return np.unique(mixed(h))


def node_of(hashes: np.ndarray) -> int:
    """An id of the set: equal sets have equal ids. Two different ones share one with a probability of 2 ** -63."""
    both = np.array([np.add.reduce(mixed(hashes + _BASE)), np.bitwise_xor.reduce(hashes), len(hashes)], np.uint64)
    return int(mixed(np.array([mixed(both[:1])[0] ^ mixed(both[1:2] + both[2])[0]], np.uint64))[0] >> _U(1))


@lru_cache(maxsize=4)
def edges_of(percent: int, upto: int) -> list[int]:
    """Lower ends of the size bands: the smaller of two linked sets is in the band of the larger or the one below."""
    ends = [1]
    while ends[-1] <= upto:
        ends.append(-(-ends[-1] * 100 // percent))
    return ends


def parts_of(band: int, ends: list[int], join: Join) -> int:
    """Parts in a band: as many as a link may change, and some more, because empty parts prove nothing."""
    changed = join.difference(2 * (ends[band + 1] - 1))
    return changed + 3 + changed // 32


def part_keys(hashes: np.ndarray, join: Join) -> tuple[np.ndarray, bytes]:
    """Keys in the document's own band and the next, and for even and odd bands how many of them may be left out.

    Empty parts give keys only where a link may change all others. Else it leaves more of them equal than may be left out,
    so if every document leaves out its most frequent ones, by an order that all have in common, the rarest part that two
    linked documents share stays. The second bit of a key tells whether the band is odd.
    """
    ends = edges_of(join.percent, 1 << max(10, (2 * len(hashes)).bit_length()))
    own = bisect_right(ends, len(hashes)) - 1
    found, spare = [], [0, 0]
    for band in (own, own + 1):
        parts = parts_of(band, ends, join)
        part = ((hashes >> _U(32)) * _U(parts)) >> _U(32)
        first = np.flatnonzero(np.diff(part, prepend=_U(parts)))
        xors, at = np.bitwise_xor.reduceat(mixed(hashes ^ _BASE), first), part[first]
        largest = min(len(hashes) * 100 // join.percent, ends[band + 1] - 1)
        certain = len(first) - join.difference(len(hashes) + largest)  # parts with shingles that a link leaves equal
        if certain < 1:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), at)
            xors, at = np.append(xors, np.zeros(len(empty), np.uint64)), np.append(at, empty)
        key = mixed(xors + mixed(at * _U(4096) + _U(band)))
        found.append(key & ~_U(2) | _U(2 * (band % 2)))
        spare[band % 2] = min(255, max(0, certain - 1))
    return np.concatenate(found), bytes(spare)


def sketch_of(hashes: np.ndarray) -> bytes:
    """One bit per shingle flipped, in a power of two of bits, at least twice as many as shingles."""
    bits = 1 << max(6, (2 * len(hashes) - 1).bit_length())
    flips = np.bincount((mixed(hashes + _U(7)) & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(flips & 1).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with fewer bits, `size` bytes: halves are XORed, as their shingles would have flipped."""
    x = np.frombuffer(sketch, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def record(what: int, rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    n = len(rows)
    empty = [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    a, x, y = (pa.array(c, k) for c, k in zip(columns, kinds))
    return pa.RecordBatch.from_arrays([a, pa.array([what] * n, pa.int32()), x, y, *empty], [f.split()[0] for f in PACKED.split(", ")])


def slice_of(key: np.ndarray, n_slices: int) -> np.ndarray:
    return ((key >> _U(32)) * _U(n_slices)) >> _U(32)


def named(key: np.ndarray, n_slices: int) -> np.ndarray:
    """What a key is called when its documents meet, whichever way they come: its slice and its low half."""
    return slice_of(key, n_slices) << _U(32) | (key >> _U(1)) & _U(0xFFFFFFFF)


def handed_over(keys: list[np.ndarray], nodes: list[int], n_slices: int, beyond: int) -> Iterator[pa.RecordBatch]:
    """Keys of some documents by slice, and apart from them the documents of keys that are hot among them.

    A slice's row holds the low halves of its keys, then for each the place of its node in a table that follows.
    """
    table = np.array(nodes, np.uint64)
    owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.lexsort((table[owner], key))
    key, owner = key[order], owner[order]
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    hot = np.repeat(counts >= HOT, counts)
    leader = np.repeat(first, counts)
    rest = np.flatnonzero(hot & (np.arange(len(key)) != leader))
    if len(rest):
        lead = leader[np.concatenate([rest, np.unique(leader[rest])])]
        members = np.concatenate([rest, np.unique(leader[rest])])
        yield record(MEMBERS, [(beyond, named(key[lead], n_slices).tobytes(), table[owner[members]].tobytes())])
    keep = ~hot | (np.arange(len(key)) == leader)
    key, owner = key[keep], owner[keep]
    place = slice_of(key, n_slices).astype(np.int64)
    bounds = np.searchsorted(place, np.arange(n_slices + 1))
    rows = []
    for s in range(n_slices):
        low, high = bounds[s], bounds[s + 1]
        if high > low:
            used, at = np.unique(owner[low:high], return_inverse=True)
            numbers = np.array([high - low, len(used)], "<u4").tobytes()
            head = numbers + ((key[low:high] >> _U(1)) & _U(0xFFFFFFFF)).astype("<u4").tobytes()
            rows.append((s, head + at.astype("<u2").tobytes(), table[used].tobytes()))
    yield record(KEYS, rows)


def packed(documents: DataFrame, join: Join, n_slices: int) -> DataFrame:
    """Rows of PACKED: documents with node and sketch, and keys by slice. A set that a task has met gives keys once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beyond = n_slices + TaskContext.get().partitionId() % n_slices
        keys, nodes, met, total = [], [], set(), 0
        for part in slices(batches, 256):
            found = [shingles(text) for text in texts_of(part)]
            ids = [node_of(h) if len(h) else None for h in found]
            sketches = [sketch_of(h) if len(h) else None for h in found]
            spare: list[bytes | None] = []
            new = []
            for node, hashes in zip(ids, found):
                spare.append(None)
                if node is not None and node not in met:
                    met.add(node)
                    key, spare[-1] = part_keys(hashes, join)
                    new.append((key, node))
            n = len(found)
            arrays = [pa.array([beyond] * n, pa.int32()), pa.array([DOCUMENTS] * n, pa.int32()), pa.array(spare, pa.binary()), pa.nulls(n, pa.binary())]
            arrays += [part.column("doc_id"), pa.array([len(h) for h in found], pa.int64()), pa.array(ids, pa.int64()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PACKED.split(", ")])
            for key, node in new:
                keys.append(key)
                nodes.append(node)
                total += len(key)
                if total >= MOST_KEYS or len(nodes) >= MOST_DOCUMENTS:
                    yield from handed_over(keys, nodes, n_slices, beyond)
                    keys, nodes, met, total = [], [], set(), 0
        if nodes:
            yield from handed_over(keys, nodes, n_slices, beyond)

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PACKED)


def met_in_slices(rows: DataFrame, n_slices: int) -> DataFrame:
    """Keys become MEMBERS (key, node) where two or more nodes have them."""

    def meet(part: pa.Table) -> pa.Table:
        slice_, what = part.column("slice")[0].as_py(), part.column("what").to_numpy()
        others = part.filter(pa.array(what != KEYS))
        key, node = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        chosen = part.filter(pa.array(what == KEYS))
        for x, y in zip(chosen.column("x").to_pylist(), chosen.column("y").to_pylist()):
            n, _ = np.frombuffer(x, "<u4", 2)
            key.append(np.frombuffer(x, "<u4", n, 8).astype(np.uint64))
            node.append(np.frombuffer(y, np.uint64)[np.frombuffer(x, "<u2", n, 8 + 4 * int(n))])
        k, v = np.concatenate(key), np.concatenate(node)
        order = np.lexsort((v, k))
        k, v = k[order], v[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
        k, v = k[new], v[new]
        _, counts = np.unique(k, return_counts=True)
        many = np.repeat(counts > 1, counts)
        k, v = k[many], v[many]
        out = [others]
        if len(k):
            made = record(MEMBERS, [(slice_, (k | _U(slice_ << 32)).tobytes(), v.tobytes())])
            out.append(pa.Table.from_batches([made]).cast(part.schema))
        return pa.concat_tables(out)

    return rows.groupBy("slice").applyInArrow(meet, PACKED)


def unpacked(rows: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two columns from the packed ones of `rows`, x and y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            columns = [np.frombuffer(part.column(c)[0].as_py(), np.int64) for c in ("x", "y")]
            for start in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 50_000]) for c in columns], list(names))

    return rows.select("x", "y").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def rare(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The members without those that their nodes may leave out: the most frequent of each node and kind of band."""
    by_key = members.repartition("key").distinct()
    often = by_key.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= FREQUENT)
    counted = by_key.join(often, "key", "left")
    odd = (F.col("key") % 2 != 0).alias("odd")
    asked = counted.filter("size IS NOT NULL").select("key", "node", "size", odd).join(nodes.select("node", "spare"), "node")
    place = F.row_number().over(W.partitionBy("node", "odd").orderBy(F.desc("size"), "key"))
    spare = F.conv(F.hex(F.substring("spare", F.col("odd").cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = asked.withColumn("place", place).filter(F.col("place") > spare).select("key", "node")
    return counted.filter("size IS NULL").select("key", "node").unionByName(kept)


def stars(members: DataFrame) -> DataFrame:
    """(leader, node): each node once with every least node of the parts that it shares, these included."""
    by_key = members.repartition("key")
    least = by_key.groupBy("key").agg(F.min("node").alias("leader"))
    return by_key.join(least, "key").select("leader", "node").distinct()


def binned(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stars with their nodes' sketches, dealt to bins. Small stars share bins; of a large one, each pair of blocks has its own."""
    sizes = rows.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size"))
    rows = rows.join(sizes.filter("size > 1").drop("size"), "leader").join(nodes.select("node", "n", "sketch"), "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    shared = F.pmod(F.xxhash64("leader"), F.lit(tasks(rows.sparkSession)))
    bin_ = F.when(F.col("blocks") == 1, shared).otherwise(F.xxhash64("leader", "i", "j"))
    return rows.select(bin_.alias("bin"), "leader", (F.col("i") != F.col("j")).alias("apart"), "own", "node", "n", "sketch")


def near_pairs(part: pa.Table, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in `part` of the pairs of one star whose sketches are no farther apart than a link allows, and how far.

    Rows are sorted by star and size, and each is compared with those behind it until these are too large to link.
    """
    leader, n, own = (part.column(c).to_numpy() for c in ("leader", "n", "own"))
    apart, sketch = part.column("apart").to_numpy(zero_copy_only=False), part.column("sketch").to_pylist()
    size = np.array([len(k) for k in sketch])
    at_size = {}  # per size: the sketches of this size and those twice as long, and where they are
    for bytes_ in np.unique(size).tolist():
        rows = np.flatnonzero((size == bytes_) | (size == 2 * bytes_))
        where = np.zeros(len(size), np.int64)
        where[rows] = np.arange(len(rows))
        at_size[bytes_] = np.stack([folded(sketch[r], bytes_) for r in rows.tolist()]), where
    x, step = np.arange(len(n) - 1), 1
    while len(x := x[x + step < len(n)]):
        y = x + step
        x = x[(leader[y] == leader[x]) & (n[y] * join.percent <= 100 * n[x])]
        for start in range(0, len(x), AT_ONCE):
            a = x[start : start + AT_ONCE]
            a = a[~apart[a] | (own[a] != own[a + step])]
            for bytes_ in np.unique(size[a]).tolist():
                of, where = at_size[bytes_]
                p = a[size[a] == bytes_]
                q = p + step
                far = np.bitwise_count(of[where[p]] ^ of[where[q]]).sum(axis=1)
                near = far <= (n[p] + n[q]) * (100 - join.percent) // (100 + join.percent)
                if near.any():
                    yield p[near], q[near], far[near] / (n[p] + n[q])[near]
        step += 1


def forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the pairs, taken in order, join two trees of those before them."""
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while (b := root.get(a, a)) != a:
            root[a] = a = root.get(b, b)
        return a

    chosen = np.zeros(len(x), bool)
    for k, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        if (a := find(a)) != (b := find(b)):
            root[a] = b
            chosen[k] = True
    return chosen


def divided(bin_: int, x: np.ndarray, y: np.ndarray, chosen: np.ndarray) -> list[dict]:
    """Rows of NEAR: the pairs of the forest, and the others in their order."""
    both = ((True, chosen), (False, ~chosen))
    return [{"bin": bin_, "forest": f, "x": x[k].tobytes(), "y": y[k].tobytes()} for f, k in both if k.any()]


def compared(rows: DataFrame, join: Join) -> DataFrame:
    """Near pairs of every bin as rows of NEAR, the nearest first."""
    schema = pa.schema([("bin", pa.int64()), ("forest", pa.bool_()), ("x", pa.binary()), ("y", pa.binary())])

    def compare(part: pa.Table) -> pa.Table:
        part = part.sort_by([("leader", "ascending"), ("n", "ascending"), ("node", "ascending")])
        bin_, node = part.column("bin")[0].as_py(), part.column("node").to_numpy()
        made, held, total = [], [], 0

        def let_go() -> None:
            p, q, far = (np.concatenate(c) for c in zip(*held))
            x, y = np.minimum(node[p], node[q]), np.maximum(node[p], node[q])
            order = np.lexsort((y, x))
            first = np.ones(len(order), bool)  # a pair of several stars counts once
            first[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
            order = order[first]
            order = order[np.argsort(far[order], kind="stable")]
            x, y = x[order], y[order]
            made.extend(divided(bin_, x, y, forest(x, y)))
            held.clear()

        for found in near_pairs(part, join):
            held.append(found)
            total += len(found[0])
            if total >= MOST_PAIRS:
                let_go()
                total = 0
        if held:
            let_go()
        return pa.Table.from_pylist(made, schema)

    return rows.groupBy("bin").applyInArrow(compare, NEAR)


def ends_of(pairs: DataFrame) -> DataFrame:
    """(bin, node): each node of a bin's pairs once. Pairs stay packed, only their ends become rows."""

    def ends(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(np.concatenate([np.frombuffer(v, np.int64) for v in xy])) for xy in zip(part.column("x").to_pylist(), part.column("y").to_pylist())]
        bins = np.repeat(part.column("bin").to_numpy(), [len(f) for f in found])
        return pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), pa.array(np.concatenate(found), pa.int64())], ["bin", "node"])

    return map_slices(pairs.select("bin", "x", "y"), ends, "bin bigint, node bigint").distinct()


def across(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the near pairs not verified yet, those whose ends are in different components, and a forest of these."""
    schema = pa.schema([("bin", pa.int64()), ("forest", pa.bool_()), ("x", pa.binary()), ("y", pa.binary())])

    known = ends_of(rest).join(labels, "node")
    empty = F.lit(None).cast("binary")
    known = known.select("bin", "node", "component", empty.alias("x"), empty.alias("y"))
    rows = known.unionByName(rest.select("bin", "x", "y"), allowMissingColumns=True)

    def divide(part: pa.Table) -> pa.Table:
        mask = part.column("node").is_valid()
        table = part.filter(mask).sort_by([("node", "ascending")])
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        made = []

        def label(v: np.ndarray) -> np.ndarray:
            if not len(node):
                return v
            at = np.minimum(np.searchsorted(node, v), len(node) - 1)
            return np.where(node[at] == v, component[at], v)

        for row in part.filter(part.column("x").is_valid()).select(["bin", "x", "y"]).to_pylist():
            x, y = np.frombuffer(row["x"], np.int64), np.frombuffer(row["y"], np.int64)
            a, b = label(x), label(y)
            k = a != b
            made += divided(row["bin"], x[k], y[k], forest(a[k], b[k]))
        return pa.Table.from_pylist(made, schema)

    return rows.groupBy("bin").applyInArrow(divide, NEAR)


def likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id is wanted, and few others: a bit per hash of a wanted id, in a filter of fixed size."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_PLACES))
    row, inside = F.floor(place / FILTER_ROW).cast("int"), (place % FILTER_ROW).cast("int")
    bits = wanted.select(row.alias("row"), inside.cast("bigint").alias("inside")).groupBy("row").agg(F.bitmap_construct_agg("inside").alias("bits"))
    byte = F.expr("cast(conv(hex(substring(bits, cast(floor(inside / 8) as int) + 1, 1)), 16, 10) as int)")
    found = rows.withColumn("row", row).withColumn("inside", inside).join(F.broadcast(bits), "row")
    return found.filter(F.getbit(byte, F.col("inside") % 8) == 1).select(*rows.columns)


def sets_of(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """(node, hashes) of the nodes that are in near pairs, from the text of one document of each."""
    wanted = written(nodes.select("doc_id").distinct(), "wanted")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text").isNotNull())

    def sets(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [h for h in map(shingles, texts_of(part)) if len(h)]
        return pa.RecordBatch.from_arrays([pa.array([node_of(h) for h in found], pa.int64()), pa.array([h.tobytes() for h in found], pa.binary())], ["node", "hashes"])

    taken = map_slices(likely(texts, wanted).join(wanted, "doc_id", "left_semi"), sets, "node bigint, hashes binary")
    return taken.dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """The pairs (x, y) that link by their shingles."""
    of = lambda side: sets.select(F.col("node").alias(side), F.col("hashes").alias(f"h_{side}"))

    def linked(part: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for p, q in zip(part.column("h_x").to_pylist(), part.column("h_y").to_pylist()):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            shared = len(np.intersect1d(p, q, assume_unique=True))
            kept.append(100 * shared >= join.percent * (len(p) + len(q) - shared))
        return part.select(["x", "y"]).filter(pa.array(kept, pa.bool_()))

    return map_slices(pairs.join(of("x"), "x").join(of("y"), "y"), linked, "x bigint, y bigint")


def merging(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Edges (a, b) that the links add to components found before, each of these as a star of its own."""
    edges = links.select(F.col("x").alias("a"), F.col("y").alias("b"))
    return edges if labels is None else edges.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))


def parity_join(documents: DataFrame, join: Join = Join()) -> DataFrame:
    """n_shingles and component_id of every document: the least doc_id that links lead to, its own included.

    A null text or one without words has an empty set and is its own component; with fewer than five words the whole
    sequence is the one shingle. Rows of one doc_id are one document for the components; equal sets are one node however
    often they occur. A null doc_id takes part, and gets its component's least id, or null. Other columns are ignored;
    an empty table gives no rows.
    """
    spark = documents.sparkSession
    n_slices = tasks(spark)
    met = written(met_in_slices(packed(documents, join, n_slices), n_slices), "parity")
    docs = met.filter(F.col("what") == DOCUMENTS).select("doc_id", "n", "node", "sketch", F.col("x").alias("spare"))
    members = unpacked(met.filter(F.col("what") == MEMBERS), ("key", "node"))
    nodes = docs.filter("node IS NOT NULL").groupBy("node").agg(*[F.min(c).alias(c) for c in ("n", "sketch", "spare", "doc_id")])

    rest = written(compared(binned(stars(rare(members, nodes)), nodes), join), "near")
    ends = ends_of(rest).select("node").distinct()
    ids = docs.select("node", "doc_id").join(ends, "node").filter("doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sets = written(sets_of(ids, documents), "sets")
    labels = None
    for _ in range(FOREST_ROUNDS):
        labels = written(components(merging(labels, written(verified(unpacked(rest.filter("forest"), ("x", "y")).distinct(), sets, join), "links"))), "labels")
        rest = written(across(rest.filter("NOT forest"), labels), "near")
    links = written(verified(unpacked(rest, ("x", "y")).distinct(), sets, join), "links")
    same_id = docs.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y"))
    final = components(merging(labels, links.union(same_id.filter("x < y").select("x", "y"))))

    first = nodes.select("node", "doc_id").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = first.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = first.join(least, "component").select("node", "component_id")
    full = docs.filter("node IS NOT NULL").join(of_node, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.union(docs.filter("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, join: Join = Join()) -> DataFrame:
    """One document of each component, the one whose id is the component's; all columns kept, repeated rows once.

    Rows without an id stay.
    """
    kept = parity_join(documents, join).filter("doc_id IS NOT NULL AND doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    chosen = documents.join(kept, documents["doc_id"] == kept["kept_id"], "left_semi").dropDuplicates(["doc_id"])
    return chosen.unionByName(documents.filter("doc_id IS NULL"))
