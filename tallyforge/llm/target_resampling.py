"""Importance resampling: documents whose hashed n-grams are frequent in a target text are likelier drawn.

Separators are collapsed to single spaces, and one overlapped scan per length, held between spaces by lookarounds, gives
every n-gram as a span of the line, whose CRC names its bucket. Buckets are counted over all documents and over the
target; a document's weight is the floored mean of its buckets' log ratios. Gumbel noise from a hash of its id turns the
highest scores into a draw without replacement, the same in every run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices, slices, texts_of, written

SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FEATURES = "doc_id bigint, n_words bigint, n_features bigint, found binary"
WEIGHTS = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"


@dataclass(frozen=True)
class Resampling:
    longest: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def line_of(text: str) -> bytes:
    """Lower case for A-Z, every run of separators one space, none at the ends."""
    return SEPARATORS.sub(b" ", text.encode().lower()).strip(b" ")


def patterns(longest: int) -> list[regex.Pattern]:
    """One per length: words between spaces, where the scan may start again inside the last match."""
    return [regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * more) for more in range(longest)]


def buckets_of(text: str, scans: list[regex.Pattern], buckets: int) -> list[np.ndarray]:
    """The bucket of every n-gram, one array per length; the first is as long as the text has words."""
    line = line_of(text)
    return [np.fromiter([crc32(m[0]) for m in scan.finditer(line, overlapped=True)], np.uint32) % buckets for scan in scans]


def kind(how: Resampling) -> str:
    """Little-endian unsigned numbers just wide enough for a bucket."""
    return "<u2" if how.buckets <= 1 << 16 else "<u4"


def scanned(texts: DataFrame, how: Resampling) -> DataFrame:
    """Rows of FEATURES from rows (doc_id, text): `found` holds the buckets as numbers of `kind(how)`."""
    scans, width = patterns(how.longest), kind(how)

    def scan(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [buckets_of(text, scans, how.buckets) for text in texts_of(part)]
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(f[0]) for f in found], pa.int64()),
                pa.array([sum(map(len, f)) for f in found], pa.int64()),
                pa.array([np.concatenate(f).astype(width).tobytes() for f in found], pa.binary()),
            ],
            ["doc_id", "n_words", "n_features", "found"],
        )

    return map_slices(texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), scan, FEATURES)


def counted(features: DataFrame, how: Resampling) -> DataFrame:
    """(bucket, n) over all rows; a task sends one row per bucket, however many n-grams it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, width = np.zeros(how.buckets, np.int64), kind(how)
        for part in slices(batches):
            for found in part.column("found"):
                total += np.bincount(np.frombuffer(found.as_py(), width), minlength=how.buckets)
        (seen,) = total.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    return features.select("found").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, how: Resampling) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus.

    The driver gets one number per bucket and table, `how.buckets` at most, however many documents there are.
    """
    s, t = (np.zeros(how.buckets, np.int64) for _ in range(2))
    for frame, total in ((corpus, s), (target, t)):
        for bucket, n in frame.collect():
            total[bucket] = n
    all_s, all_t = float(s.sum() + how.buckets), float(t.sum() + how.buckets)
    shares = ((t + 1.0) * all_s) / ((s + 1.0) * all_t)
    return np.array([math.floor(1000 * math.log(x)) for x in shares], np.int64)


def weighted(features: DataFrame, gain: np.ndarray, how: Resampling) -> DataFrame:
    """Rows of WEIGHTS: the floored mean of the document's gains, 0 without any."""

    width = kind(how)

    def weigh(part: pa.RecordBatch) -> pa.RecordBatch:
        sums = [int(gain[np.frombuffer(f.as_py(), width)].sum()) for f in part.column("found")]
        mean = [total // n if n else 0 for total, n in zip(sums, part.column("n_features").to_pylist())]
        return pa.RecordBatch.from_arrays([*[part.column(c) for c in ("doc_id", "n_words", "n_features")], pa.array(mean, pa.int64())], [f.split()[0] for f in WEIGHTS.split(", ")])

    return map_slices(features, weigh, WEIGHTS)


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash of the id; a null id is hashed as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(scored: DataFrame, how: Resampling) -> DataFrame:
    """`scored` with `rank` among the drawn: descending score, then ascending id, null ids first; null for all others.

    Scores are thousandths of logarithms, so there are some 100,000 different ones at most, however many documents. Their
    counts say where each score's ranks begin and which scores are drawn at all; only those rows are sorted, score by score.
    """
    able = F.col("n_words") >= how.least_words
    counts = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above, everything = W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    counts = counts.select(
        F.col("score"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"),
        F.floor(F.sum("n").over(everything) * how.percent / 100).alias("drawn"),
    )
    within = W.partitionBy("score").orderBy("doc_id")
    placed = scored.join(F.broadcast(counts), "score", "left").withColumn("near", able & (F.col("before") < F.col("drawn")))
    near = placed.filter("near").withColumn("place", F.col("before") + F.row_number().over(within))
    near = near.withColumn("rank", F.when(F.col("place") <= F.col("drawn"), F.col("place")).cast("bigint")).drop("place")
    rest = placed.filter("near is null or not near").withColumn("rank", F.lit(None).cast("bigint"))
    return near.unionByName(rest).drop("before", "drawn", "near")


def target_resampling(documents: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """Every document's n_words, n_features, weight, score, and its rank if it is drawn.

    `documents` has doc_id and text, `target` has text. A null text is an empty one: no features, weight 0, never drawn,
    as it has too few words. Ties in score go to the smaller doc_id, a null one first; repeated rows each count and each
    get a rank, in any order among themselves. Very long texts are scanned whole, in memory that is some multiple of the
    longest one. An empty target gives every bucket the same share of nothing; an empty table of documents gives no rows.
    Other columns are ignored. Both tables are read once: their buckets are written to the shared folder and reread.
    """
    features = written(scanned(documents, how), "features")
    wanted = scanned(target.select(F.lit(0).alias("doc_id"), "text"), how)
    gain = gains(counted(features, how), counted(wanted, how), how)
    scored = weighted(features, gain, how).withColumn("score", F.col("weight") + noise("doc_id", how.seed))
    return ranked(written(scored, "scores"), how)
