"""What several operators share: slices of Arrow batches, whole-word patterns, folders for written tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import work_folder

#: Rows handled at a time inside a task, whatever the size of the batches Spark sends.
SLICE_ROWS = 512
#: What separates words, as bytes.split() and the pattern [^\x20\x09-\x0D]+ have it.
BLANKS = " \t\n\v\f\r"
HELD_OUT_FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the rows no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT_FOLDS == HELD_OUT


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(frame: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`make` for every slice of the frame's rows, inside the tasks that read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if (made := make(part)) is not None and made.num_rows:
                yield made

    return frame.mapInArrow(run, schema)


def texts_of(part: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null ones empty."""
    return [x or "" for x in part.column(column).to_pylist()]


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read again: a cut of its lineage that outlives executors."""
    return stored(frame, f"{work_folder(frame.sparkSession, label)}/{uuid.uuid4().hex}")


def stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*[frame[c] for c in columns]) if columns else frame


LETTER_RUN = re.compile(r"[^\W\d_]+")
