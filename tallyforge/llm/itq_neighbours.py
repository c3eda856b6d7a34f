"""Near-duplicate vectors by iterative quantisation: balanced binary codes, Hamming tables over parts of them, exact rerank.

Each of several rotations is learnt so that the signs of the rotated vectors lose as little as possible. Their bits are
cut into tables; vectors whose bits agree in one table meet there, and their cosine decides. The width of a table grows
with the logarithm of the number of vectors, so that buckets stay small; the number of tables follows from the recall
wanted for a pair that just links. A large bucket is cut into blocks, and every pair of blocks is a group of its own.
From a group come counts per vector and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices, tasks, written
from tallyforge.llm.components import components

#: Vectors of one block of a large bucket, about.
BLOCK = 512
ENTRIES = "node bigint, weight bigint, vector binary, keys binary, t int, key bigint"


@dataclass(frozen=True)
class Index:
    """`sample`: about so many vectors, chosen by hash, fit the rotations; `iterations` of the fit for each.

    `recall` is what a pair at the threshold is found with; pairs closer than that are found more surely.
    """

    cosine: float = 0.95
    recall: float = 0.97
    sample: int = 8192
    iterations: int = 30
    least_bits: int = 12
    seed: int = 7

    def shape(self, n: int) -> tuple[int, int]:
        """Bits per table, and tables, for n vectors."""
        bits = min(62, max(self.least_bits, math.ceil(math.log2(max(n, 2)))))
        met = (1 - math.acos(self.cosine) / math.pi) ** bits
        return bits, math.ceil(math.log(1 - self.recall) / math.log(1 - met))


def unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one in double precision, and which rows have one. All valid rows have equal lengths."""
    rows = [v if v is not None and len(v) and None not in v else None for v in vectors]
    valid = np.array([r is not None and bool(np.isfinite(np.array(r, float)).all()) and any(r) for r in rows], bool)
    table = np.array([r for r, ok in zip(rows, valid) if ok], float)
    if len(table):
        table /= np.abs(table).max(axis=1, keepdims=True)
        table /= np.linalg.norm(table, axis=1, keepdims=True)
    return table, valid


def rotations(sample: np.ndarray, bits: int, how: Index) -> tuple[np.ndarray, np.ndarray]:
    """The mean, and `bits` columns to project on: as many learnt rotations side by side as it takes.

    Each starts from a random rotation of the principal axes and alternates between the signs that fit the rotated
    vectors and the rotation that fits the signs. A rank below the dimension gives shorter codes per rotation.
    """
    dims = sample.shape[1]
    mean, random = sample.mean(axis=0), np.random.default_rng(how.seed)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    projected, columns = centred @ axes, []
    while sum(c.shape[1] for c in columns) < bits:
        turn, _ = np.linalg.qr(random.standard_normal((dims, dims)))
        for _ in range(how.iterations):
            signs = np.where(projected @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ projected)
            turn = (u @ v).T
        columns.append(axes @ turn)
    return mean, np.concatenate(columns, axis=1)[:, :bits]


def table_keys(vectors: np.ndarray, mean: np.ndarray, columns: np.ndarray, bits: int) -> np.ndarray:
    """One row per vector and one key per table."""
    signs = ((vectors - mean) @ columns >= 0).astype(np.int64).reshape(len(vectors), -1, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs (two rows of indices)."""
    root, kept = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(*pairs.tolist()):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def linked(part: pa.Table, bits_tables: int, cosine: float) -> pa.Table:
    """Links inside the buckets of a group: per vector how much weight it links to, and a forest of the links.

    A pair that meets in several tables counts in the first.
    """
    part = part.sort_by([("t", "ascending"), ("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")])
    t, key, i, j, own, node, weight = (part.column(c).to_numpy() for c in ("t", "key", "i", "j", "own", "node", "weight"))
    vectors = np.frombuffer(b"".join(part.column("vector").to_pylist()), float).reshape(len(t), -1)
    keys = np.frombuffer(b"".join(part.column("keys").to_pylist()), np.int64).reshape(len(t), bits_tables)
    change = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
    bounds = [0, *change.tolist(), len(t)]
    counts, edges = np.zeros(len(t), np.int64), []
    for low, high in zip(bounds, bounds[1:]):
        own_part, inside = own[low:high], vectors[low:high]
        rows = np.flatnonzero(own_part == i[low])
        others = rows if i[low] == j[low] else np.flatnonzero(own_part == j[low])
        hits = np.argwhere(inside[rows] @ inside[others].T >= cosine - 1e-12)
        a, b = rows[hits[:, 0]], others[hits[:, 1]]
        if i[low] == j[low]:
            a, b = a[a < b], b[a < b]
        exact = np.einsum("nd,nd->n", inside[a], inside[b]) >= cosine
        a, b = a[exact] + low, b[exact] + low
        first = (keys[a, : t[low]] != keys[b, : t[low]]).all(axis=1)
        a, b = a[first], b[first]
        np.add.at(counts, a, weight[b])
        np.add.at(counts, b, weight[a])
        edges += forest(len(t), np.stack([a, b])) if len(a) else []
    found = np.flatnonzero(counts)
    left = np.array([a for a, _ in edges], np.int64)
    right = np.array([b for _, b in edges], np.int64)
    nodes = np.concatenate([node[found], node[left]])
    partner = pa.array([None] * len(found) + node[right].tolist(), pa.int64())
    n = pa.array(counts[found].tolist() + [0] * len(left), pa.int64())
    return pa.table({"node": pa.array(nodes, pa.int64()), "partner": partner, "n": n})


def itq_neighbours(embeddings: DataFrame, how: Index = Index()) -> DataFrame:
    """n_links, component_id and kept of every vector (vec_id, embedding).

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing. Equal vectors are one
    node with a weight, so copies are never paired; repeated rows are such copies, and each is returned. Vectors of
    another length than most link with those of their own length only. A null vec_id counts as a vector and has the
    component of the others, or null if it is alone. Other columns are ignored; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    kinds = {"vector": pa.binary(), "dims": pa.int32()}

    def normal(part: pa.RecordBatch) -> pa.RecordBatch:
        vectors = part.column("embedding").to_pylist()
        out: list = [None] * len(vectors)
        dims: list = [None] * len(vectors)
        for length in sorted({len(v) for v in vectors if v}):
            chosen = [k for k, v in enumerate(vectors) if v and len(v) == length]
            table, valid = unit([vectors[k] for k in chosen])
            for k, row in zip([k for k, ok in zip(chosen, valid) if ok], table):
                out[k], dims[k] = row.tobytes(), length
        arrays = [part.column("vec_id"), pa.array(out, kinds["vector"]), pa.array(dims, kinds["dims"])]
        return pa.RecordBatch.from_arrays(arrays, ["vec_id", "vector", "dims"])

    vectors = written(map_slices(rows, normal, "vec_id bigint, vector binary, dims int"), "vectors")
    valid = vectors.filter("vector IS NOT NULL")
    nodes = valid.groupBy("vector", "dims").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("vec_id"))
    nodes = written(nodes.withColumn("node", F.xxhash64("vector")), "nodes")
    found = None
    for length, n in sorted((r["dims"], r["n"]) for r in nodes.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()):
        one = links_of(nodes.filter(F.col("dims") == length), n, how)
        found = one if found is None else found.union(one)
    alone = vectors.filter("vector IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    found = written(found, "links")
    counts = found.filter("partner IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(found.filter("partner IS NOT NULL").select(F.col("node").alias("a"), F.col("partner").alias("b")))
    named = nodes.select("node", "weight", "vec_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_node = named.join(least, "component").join(counts, "node", "left")
    of_node = of_node.select("node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    full = valid.select("vec_id", F.xxhash64("vector").alias("node")).join(of_node, "node").select("vec_id", "n_links", "component_id")
    return full.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def links_of(nodes: DataFrame, n: int, how: Index) -> DataFrame:
    """Rows (node, partner, n): counts have no partner, edges of the forest no count. `nodes` have vectors of one length."""
    spark = nodes.sparkSession
    steps = 1_000_000
    chosen = nodes.filter(F.pmod("node", F.lit(steps)) < max(1, math.ceil(steps * how.sample / n)))
    sample = np.array([np.frombuffer(r["vector"], float) for r in chosen.select("vector").orderBy("vector").collect()])
    bits, tables = how.shape(n)
    if len(sample) < 2:
        sample = np.array([np.frombuffer(r["vector"], float) for r in nodes.select("vector").limit(how.sample).collect()])
    mean, columns = rotations(sample, bits * tables, how)
    shared = spark.sparkContext.broadcast((mean, columns))

    def entries(part: pa.RecordBatch) -> pa.RecordBatch:
        raw = part.column("vector").to_pylist()
        keys = table_keys(np.array([np.frombuffer(v, float) for v in raw]), *shared.value, bits)
        t = np.tile(np.arange(tables, dtype=np.int32), len(raw))
        at = pa.array(np.repeat(np.arange(len(raw)), tables))
        packed = pa.array([k.tobytes() for k in keys], pa.binary())
        columns_ = [part.column("node").take(at), part.column("weight").take(at), part.column("vector").take(at), packed.take(at)]
        return pa.RecordBatch.from_arrays([*columns_, pa.array(t), pa.array(keys.reshape(-1))], [f.split()[0] for f in ENTRIES.split(", ")])

    def places(part: pa.RecordBatch) -> pa.RecordBatch:
        keys = table_keys(np.array([np.frombuffer(v, float) for v in part.column("vector").to_pylist()]), *shared.value, bits)
        t = np.tile(np.arange(tables, dtype=np.int32), len(keys))
        return pa.RecordBatch.from_arrays([pa.array(t), pa.array(keys.reshape(-1))], ["t", "key"])

    sizes = map_slices(nodes.select("vector"), places, "t int, key bigint").groupBy("t", "key").agg(F.count(F.lit(1)).alias("size"))
    buckets = sizes.filter("size > 1").select("t", "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = map_slices(nodes.select("node", "weight", "vector"), entries, ENTRIES).join(buckets, ["t", "key"])
    rows = rows.withColumn("own", F.pmod("node", F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    rows = rows.withColumn("bin", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("t", "key"), F.lit(16 * tasks(spark)))).otherwise(F.xxhash64("t", "key", "i", "j")))
    cosine = how.cosine

    def compare(part: pa.Table) -> pa.Table:
        return linked(part, tables, cosine)

    columns_ = ["bin", "t", "key", "i", "j", "own", "node", "weight", "vector", "keys"]
    return rows.select(*columns_).groupBy("bin").applyInArrow(compare, "node bigint, partner bigint, n bigint")
