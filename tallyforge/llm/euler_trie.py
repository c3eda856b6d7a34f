"""The trie of conversations' shared beginnings, measured by an Euler tour that is ranked as a distributed list.

Every node of the trie has an arc into it and one out of it. Where an arc is followed by which is known from the node's
first child, next sibling and parent alone, so the tour is a linked list in a table. The list is ranked by contraction:
arcs that toss heads take in the arc behind them if that one tossed tails, round after round, until one task can walk
what is left; then the arcs taken in get their places back, round by round. Sums carried along are prefix sums of the
tour, and a node's subtree is the difference between its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.llm.common import tasks, written

WORDS = r"[^\x20\x09-\x0D]+"
ARC = ["c", "d", "x"]  # the node's conv_id and depth, 0 into it and 1 out of it
NEXT = ["nc", "nd", "nx"]
SUMS = ["n", "leaves", "saved"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Trie:
    group: int = 20  # conversations c - c % group give their beginnings to c
    most_shared: int = 3
    span: int = 1_024  # rows of one conversation, siblings of one parent, or ids of one digest's part, handled in one piece
    walked: int = 16_384  # arcs that one task may walk


def donor(c: str, how: Trie) -> Column:
    return F.col(c) - F.col(c) % how.group


def shared(c: str, how: Trie) -> Column:
    """How many turns conversation `c` wants of its donor."""
    return (F.crc32(F.col(c).cast("string").cast("binary")) % (how.most_shared + 1)).cast("bigint")


def before(rows: DataFrame, key: str, block: str, fold: Callable[[str], Column], *columns: str) -> DataFrame:
    """(key, block, the columns folded over the key's earlier blocks), so that a long key's rows need no common task.

    `fold` must be a sum of some kind: blocks are folded on their own and then with each other.
    """
    earlier = W.partitionBy(key).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(key, block).agg(*[fold(c).alias(c) for c in columns])
    return totals.select(key, block, *[F.coalesce(fold(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns])


def placed(conversations: DataFrame, how: Trie) -> DataFrame:
    """(c, p, t1, t2, words) of every turn: its place in its conversation, two hashes of role and text, words of the text."""
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("c"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text")],
    )
    turns = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / how.span), F.lit(-(1 << 62))))
    within = W.partitionBy("c", "block").orderBy("turn", "role", "text")
    turns = turns.select(
        "c",
        "block",
        F.row_number().over(within).cast("bigint").alias("r"),
        *[F.xxhash64(F.lit(seed), "role", "text").alias(f"t{seed}") for seed in (1, 2)],
        F.regexp_count("text", F.lit(WORDS)).cast("bigint").alias("words"),
    )
    turns = written(turns, "turns")
    earlier = before(turns.withColumn("rows", F.lit(1).cast("bigint")), "c", "block", F.sum, "rows")
    return turns.join(earlier, ["c", "block"]).select("c", (F.col("r") + F.col("rows_before")).alias("p"), "t1", "t2", "words")


def rebuilt(turns: DataFrame, how: Trie) -> tuple[DataFrame, DataFrame]:
    """(c, depth) of every conversation, and (c, p, words, h1, h2, k1, k2, last) of every rebuilt turn.

    h1 and h2 hash the turn together with its place; k1 and k2 are the xors of these from the first turn on, so that
    equal k1 and k2 at equal places are equal beginnings, and the parent's are found by taking the last turn out.
    """
    turn = F.struct("p", "t1", "t2", "words")
    heads = turns.filter((F.col("p") <= how.most_shared) & (F.col("c") == donor("c", how)))
    heads = heads.groupBy(F.col("c").alias("donor")).agg(F.array_sort(F.collect_list(turn)).alias("head"))  # most_shared at most
    convs = turns.groupBy("c").agg(F.max("p").alias("own")).select("c", "own", donor("c", how).alias("donor"), shared("c", how).alias("h"))
    convs = convs.join(heads, "donor", "left").withColumn("head", F.filter(F.coalesce("head", F.array()), lambda t: t["p"] <= F.col("h")))
    convs = convs.withColumn("m", F.size("head").cast("bigint")).withColumn("depth", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = written(convs.select("c", "h", "m", "depth", "head"), "conversations")
    tail = turns.join(convs.drop("head"), "c").filter("p > h").withColumn("p", F.col("p") - F.col("h") + F.col("m"))
    head = convs.select("c", "depth", F.explode("head").alias("t")).select("c", "depth", "t.*")
    rows = tail.select(*head.columns).unionByName(head)
    rows = rows.withColumns({f"h{seed}": F.xxhash64(F.lit(seed), "p", "t1", "t2") for seed in (1, 2)})
    rows = rows.withColumn("block", F.floor((F.col("p") - 1) / how.span))
    so_far = W.partitionBy("c", "block").orderBy("p")
    rows = written(
        rows.select("c", "block", "p", "words", "h1", "h2", *[F.bit_xor(h).over(so_far).alias(h.replace("h", "k")) for h in ("h1", "h2")], (F.col("p") == F.col("depth")).alias("last")),
        "beginnings",
    )
    earlier = before(rows, "c", "block", F.bit_xor, "h1", "h2")
    keys = [F.col(f"k{s}").bitwiseXOR(F.col(f"h{s}_before")).alias(f"k{s}") for s in (1, 2)]
    return convs.select("c", "depth"), rows.join(earlier, ["c", "block"]).select("c", "p", "words", "h1", "h2", *keys, "last")


def nodes_of(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, conv_id, n_convs, words, p1, p2, n_children), the root with keys 0; p1 and p2 are the parent's keys."""
    parent = [F.col(f"k{s}").bitwiseXOR(F.col(f"h{s}")).alias(f"p{s}") for s in (1, 2)]
    below = rows.groupBy(F.col("p").alias("depth"), "k1", "k2").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.first(x).alias(x) for x in ("words", "h1", "h2")]
    )
    below = below.select("depth", "k1", "k2", "conv_id", "n_convs", "words", *parent)
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(*[zero.alias(x) for x in ("depth", "k1", "k2")], "conv_id", "n_convs", zero.alias("words"), none.alias("p1"), none.alias("p2"))
    nodes = written(below.unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    counts = children.agg(F.count(F.lit(1)).alias("n_children"))
    return written(nodes.join(counts, ["depth", "k1", "k2"], "left").fillna(0, ["n_children"]), "trie")


def siblings(nodes: DataFrame, how: Trie) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, parent_conv_id, sibling) of all nodes but the root; (c, d, child) of all parents.

    Children of one parent are dealt into so many bins that each holds about `span`. They are linked inside their bins,
    and the last of a bin to the first of the next one.
    """
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("brood")
    )
    kids = nodes.filter("depth > 0").select("depth", "p1", "p2", "conv_id").join(parents, ["depth", "p1", "p2"])
    bins = F.ceil(F.col("brood") / how.span)
    kids = kids.select("conv_id", "depth", "parent_conv_id", F.pmod(F.xxhash64("conv_id"), bins).alias("bin"))
    kids = written(kids, "children")
    parent, within = ["parent_conv_id", "depth"], W.partitionBy("parent_conv_id", "depth", "bin").orderBy("conv_id")
    over_bins = W.partitionBy(*parent).orderBy("bin")
    firsts = kids.groupBy(*parent, "bin").agg(F.min("conv_id").alias("first"))
    firsts = firsts.select(*parent, "bin", "first", F.lead("first").over(over_bins).alias("onward"), F.row_number().over(over_bins).alias("nth"))
    linked = kids.withColumn("sibling", F.lead("conv_id").over(within)).join(firsts, [*parent, "bin"])
    linked = linked.select("conv_id", "depth", "parent_conv_id", F.coalesce("sibling", "onward").alias("sibling"))
    eldest = firsts.filter("nth = 1").select(F.col("parent_conv_id").alias("c"), (F.col("depth") - 1).alias("d"), F.col("first").alias("child"))
    return linked, eldest


def arcs(nodes: DataFrame, linked: DataFrame, eldest: DataFrame) -> DataFrame:
    """The tour as a list: ARC, the arc behind it in NEXT (null at the end), and what the arc itself adds to SUMS."""
    into, out, zero = F.lit(0), F.lit(1), F.lit(0).cast("bigint")
    node = nodes.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "n_children", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    child = F.col("child").isNotNull()
    enter = node.join(eldest, ["c", "d"], "left").select(
        "c", "d", into.alias("x"), F.coalesce("child", "c").alias("nc"), (F.col("d") + child.cast("bigint")).alias("nd"), F.when(child, into).otherwise(out).alias("nx"),
        F.lit(1).cast("bigint").alias("n"), (F.col("n_children") == 0).cast("bigint").alias("leaves"), "saved",
    )
    more = F.col("sibling").isNotNull()
    leave = node.select("c", "d").join(linked.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "parent_conv_id", "sibling"), ["c", "d"], "left").select(
        "c", "d", out.alias("x"), F.coalesce("sibling", "parent_conv_id").alias("nc"),
        F.when(F.col("d") > 0, F.col("d") - (~more).cast("bigint")).alias("nd"), F.when(F.col("d") > 0, F.when(more, into).otherwise(out)).alias("nx"),
        F.lit(1).cast("bigint").alias("n"), zero.alias("leaves"), zero.alias("saved"),
    )
    return enter.unionByName(leave)


def contracted(tour: DataFrame, toss: int) -> DataFrame:
    """A round: heads take in the tails behind them, a quarter of all arcs on average. `gone` holds the arc taken in and the
    taker's sums until then, which are the distance between the two."""
    heads = F.xxhash64(F.lit(toss), *ARC).bitwiseAND(1) == 1
    taker = tour.filter(heads).alias("a")
    taken = tour.filter(~heads).alias("b")
    both = taker.join(taken, [F.col(f"a.{n}") == F.col(f"b.{i}") for n, i in zip(NEXT, ARC)], "full_outer")
    head, tail = F.col("a.c").isNotNull(), F.col("b.c").isNotNull()
    merged = head & tail
    return both.select(
        *[F.when(head, F.col(f"a.{i}")).otherwise(F.col(f"b.{i}")).alias(i) for i in ARC],
        *[F.when(tail, F.col(f"b.{n}")).otherwise(F.col(f"a.{n}")).alias(n) for n in NEXT],
        *[(F.coalesce(f"a.{s}", F.lit(0)) + F.coalesce(f"b.{s}", F.lit(0))).alias(s) for s in SUMS],
        F.when(merged, F.struct(*[F.col(f"b.{i}").alias(i) for i in ARC], *[F.col(f"a.{s}").alias(s) for s in SUMS])).alias("gone"),
    )


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ARC and the sums of all arcs in front of it, for a list that fits one task."""
    rows = [row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)])]
    if not rows:
        return
    by_arc = {row[:3]: row for row in rows}
    (at,) = by_arc.keys() - {row[3:6] for row in rows}
    total, out = (0,) * len(SUMS), []
    while at in by_arc:
        out.append((*at, *total))
        total = tuple(t + w for t, w in zip(total, by_arc[at][6:]))
        at = by_arc[at][3:6]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * len(SUMS)]
    yield pa.RecordBatch.from_arrays([pa.array(col, kind) for col, kind in zip(zip(*out), kinds)], [*ARC, *SUMS])


def ranked(tour: DataFrame, how: Trie) -> DataFrame:
    """ARC and the SUMS of all arcs in front of it. Rounds grow with the logarithm of the list; each is written."""
    rounds, now = [], written(tour, "tour")
    while now.count() > how.walked:
        rounds.append(written(contracted(now, len(rounds)), "round"))
        now = rounds[-1].drop("gone")
    places = now.select(*ARC, *NEXT, *SUMS).repartition(1).mapInArrow(walk, "c bigint, d bigint, x int, " + ", ".join(f"{s} bigint" for s in SUMS))
    for taken in reversed(rounds):
        takers = taken.filter("gone is not null").select(*ARC, "gone")
        both = places.join(takers, ARC, "left")
        self, other = (F.struct(*ARC, *SUMS), F.struct(*[F.col(f"gone.{i}").alias(i) for i in ARC], *[(F.col(s) + F.col(f"gone.{s}")).alias(s) for s in SUMS]))
        places = both.select(F.explode(F.when(F.col("gone").isNull(), F.array(self)).otherwise(F.array(self, other))).alias("r")).select("r.*")
        places = written(places, "places")
    return places


def digests(convs: DataFrame, rows: DataFrame, how: Trie) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes where conversations end, their ids ascending and joined by commas.

    Ids are joined `span` of the number line at a time, and a node's parts are hashed one after the other as they stream by.
    """
    zero = F.lit(0).cast("bigint")
    ends = rows.filter("last").select(F.col("p").alias("depth"), "k1", "k2", "c").unionByName(
        convs.filter("depth = 0").select("depth", zero.alias("k1"), zero.alias("k2"), "c")
    )
    node = ["depth", "k1", "k2"]
    parts = ends.groupBy(*node, F.floor(F.col("c") / how.span).alias("part")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    parts = parts.select(*node, "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for *key, _, text in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                if key == at:
                    state.update(b",")
                else:
                    if state:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(text.encode())
            if done:
                yield table_of(done)
        if state:
            yield table_of([(*at, state.hexdigest())])

    def table_of(done: list[tuple]) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 3, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(col, kind) for col, kind in zip(zip(*done), kinds)], [*node, "ends_sha256"])

    dealt = parts.repartition(tasks(parts.sparkSession), *node).sortWithinPartitions(*node, "part")
    return dealt.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def euler_trie(conversations: DataFrame, how: Trie = Trie()) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. A node's last turn is turn `depth` of its conv_id as rebuilt.

    Turns are ordered by turn, null first, ties by role and text as bytes; a null role or text is empty; repeated rows are
    turns of their own. Rows without a conv_id belong to no conversation and are left out. For a negative conv_id the
    remainder has its sign, as SQL has it. Other columns are ignored; an empty table has no root and gives no rows. Very
    long texts are hashed and counted where they are read. Turns are told apart by two 64-bit hashes.
    """
    turns = written(placed(conversations, how), "placed")
    convs, rows = rebuilt(turns, how)
    rows = written(rows, "rebuilt")
    nodes = nodes_of(convs, rows)
    linked, eldest = siblings(nodes, how)
    linked = written(linked, "siblings")
    places = ranked(arcs(nodes, linked, eldest), how)
    sums = [F.sum(F.when(F.col("x") == 1, F.col(s)).otherwise(-F.col(s))).alias(s) for s in ("leaves", "saved")]
    inside = places.groupBy(F.col("c").alias("conv_id"), F.col("d").alias("depth")).agg(*sums)
    whole = nodes.join(digests(convs, rows, how), ["depth", "k1", "k2"], "left").join(inside, ["conv_id", "depth"]).join(linked, ["conv_id", "depth"], "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
