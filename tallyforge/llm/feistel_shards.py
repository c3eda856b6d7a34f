"""A reproducible shuffle into shards: global row numbers go through a keyed Feistel permutation with cycle walking.

The permutation works on pairs (left, right) of two radices whose product is the smallest such grid that holds all
rows, so shard and slot of any row number can be computed without a table, and the inverse gives the row of any slot.
Only built-in functions: no Python runs in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The round function works modulo this prime, so that its products fit into 63 bits.
PRIME = 2147483647
MULTIPLIER = 48271
#: Steps of the cycle walk. At most radix - 1 numbers lie outside the range, and a walk leaves it with a probability
#: below 1 / radix per step: a grid of up to 64 x 64 can't need more, a larger one needs more with at most 64 ** -64.
WALK = 64


@dataclass(frozen=True)
class Shuffle:
    """`buckets`: groups in which rows are numbered side by side; rows of one bucket are sorted by one task."""

    shards: int = 16
    seed: int = 20240601
    rounds: int = 8
    buckets: int = 4096

    def keys(self) -> list[int]:
        """Round keys, from the seed by the same multiplier."""
        keys, x = [], self.seed % PRIME or 1
        for _ in range(self.rounds):
            x = x * MULTIPLIER % PRIME
            keys.append(x)
        return keys


def mixed(value: Column, key: Column) -> Column:
    """A pseudo-random number below PRIME: two rounds of y * (y + multiplier) + key modulo the prime."""
    folded = (value % PRIME + F.floor(value / PRIME) + key) % PRIME
    once = (folded * ((folded + MULTIPLIER) % PRIME) + key) % PRIME
    return (once * ((once + MULTIPLIER) % PRIME) + folded) % PRIME


def permuted(number: Column, total: Column, shuffle: Shuffle) -> Column:
    """The place of row `number` among `total` rows. Needs 0 <= number < total."""
    left_radix = F.ceil(F.sqrt(total.cast("double"))).cast("bigint")
    right_radix = F.ceil(total / left_radix).cast("bigint")
    keys = F.array(*[F.lit(k).cast("bigint") for k in shuffle.keys()])

    def pair(left: Column, right: Column, radix: Column, other: Column) -> Column:
        return F.struct(left.alias("l"), right.alias("r"), radix.alias("a"), other.alias("b"))

    def one_round(state: Column, key: Column) -> Column:
        """(l, r) of radices (a, b) becomes (r, l + f(r) mod a) of radices (b, a)."""
        left, right, a, b = (state.getField(f) for f in "lrab")
        return pair(right, (left + mixed(right, key) % a) % a, b, a)

    def once(x: Column) -> Column:
        start = pair(F.floor(x / right_radix).cast("bigint"), (x % right_radix).cast("bigint"), left_radix, right_radix)
        return F.aggregate(keys, start, one_round, lambda s: s.getField("l") * right_radix + s.getField("r"))

    steps = F.sequence(F.lit(1), F.lit(WALK))
    first = F.aggregate(F.array(number.cast("bigint")), F.lit(-1).cast("bigint"), lambda _, x: once(x))
    walked = F.aggregate(steps, first, lambda x, _: F.when(x < total, x).otherwise(once(x)))
    return F.aggregate(
        F.array(walked), F.lit(-1).cast("bigint"), lambda _, x: F.when(x < total, x).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("bigint"))
    )


def numbered(rows: DataFrame, order: list[str], buckets: int, name: str = "row_number") -> DataFrame:
    """The rows with a gapless number from 0: by bucket (a hash of `order`), then by `order` within it.

    Equal rows get numbers in any order, which leaves the result the same. Counts of the buckets, at most `buckets`
    rows, are the only thing that meets in one task.
    """
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    everything = W.orderBy("bucket")
    before = F.sum("n").over(everything.rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("first"), F.sum("n").over(everything.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("total"))
    inside = F.row_number().over(W.partitionBy("bucket").orderBy(*order)).cast("bigint") - 1
    joined = bucketed.withColumn("inside", inside).join(F.broadcast(offsets), "bucket")
    return joined.withColumn(name, F.col("first") + F.col("inside")).drop("bucket", "inside", "first")


def feistel_shards(documents: DataFrame, shuffle: Shuffle = Shuffle()) -> DataFrame:
    """Shard and slot of every document, by the law `rows`: counts of shards differ by one at most.

    Place p of the permutation is slot p div shards of shard p mod shards. A null text has size 1 and crc 0, like an
    empty one; a null doc_id is numbered like any other. Repeated rows are placed one by one; other columns are
    ignored; an empty table gives no rows. Texts are reduced to size and crc before anything is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    small = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = numbered(small, ["doc_id", "size", "text_crc32"], shuffle.buckets)
    place = rows.withColumn("place", permuted(F.col("row_number"), F.col("total"), shuffle))
    return place.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("place") % shuffle.shards).cast("int").alias("shard"),
        F.floor(F.col("place") / shuffle.shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
