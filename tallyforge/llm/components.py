"""Connected components of an edge table, by alternating large and small stars until nothing changes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written

#: Edges that a task holds at a time to shorten the paths among them.
MOST_EDGES = 1 << 18


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges that join the same nodes: those a task holds at a time become stars around their least nodes."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(node: int) -> int:
            while (up := root.get(node, node)) != node:
                root[node] = node = root.get(up, up)
            return node

        for part in held:
            for x, y in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
                if (x := find(x)) != (y := find(y)):
                    root[max(x, y)] = min(x, y)
        tied = list(root)
        return pa.RecordBatch.from_arrays([pa.array(tied, pa.int64()), pa.array([find(n) for n in tied], pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            held.append(batch)
            total += batch.num_rows
            if total >= MOST_EDGES:
                yield stars(held)
                held, total = [], 0
        if held:
            yield stars(held)

    return edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).mapInArrow(run, "a bigint, b bigint")


def _settled(edges: DataFrame) -> bool:
    """Every component is a star around its least node: no node has two below it, or one below and one above."""
    none = F.lit(None).cast("bigint")
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("below"), F.lit(False).alias("above"))
    ends = ends.union(edges.select(F.col("b").alias("node"), none.alias("below"), F.lit(True).alias("above")))
    seen = ends.groupBy("node").agg(F.min("below").alias("least"), F.max("below").alias("most"), F.max("above").alias("above"))
    return seen.filter("least < most OR least IS NOT NULL AND above").agg(F.count(F.lit(1))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of these. Edges lead from the larger node a to b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (a, b); the component is its least node.

    Loops and repeated edges are allowed. Each task first shortens the paths among the edges it reads, so the rounds grow
    with the logarithm of the longest path that is left; they end with the first that leaves stars alone. Each is written to
    the shared folder, so that a lost executor costs one round. A hub's neighbours are never gathered: minima are partial
    aggregates, and its rows meet them in a join that adaptive execution can split.
    """
    now = written(_contracted(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")), "edges")
    while not _settled(now):
        now = written(_small_star(_large_star(_contracted(now))), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
