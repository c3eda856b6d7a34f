"""A corpus from raw documents: toxic and foreign texts out, near copies out, secrets masked, the rest packed.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.bitmask_language import in_known_language
from tallyforge.llm.common import stored, table
from tallyforge.llm.parity_join import one_of_each
from tallyforge.llm.random_secrets import redacted
from tallyforge.llm.tier_packing import tier_packing
from tallyforge.llm.weak_toxicity import not_toxic
from tallyforge.session import work_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return not_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus knows."""
    return in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component of near copies."""
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids."""
    return tier_packing(docs, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]
#: Models, joins over components and a tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), work_folder(spark, f"stage-{name}"))
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), work_folder(spark, f"stage-{name}"))
