"""The operators as queries over whole tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.bitmask_language import bitmask_language
from tallyforge.llm.chunk_bpe import chunk_bpe
from tallyforge.llm.common import table
from tallyforge.llm.dictionary_ids import dictionary_ids
from tallyforge.llm.euler_trie import euler_trie
from tallyforge.llm.feistel_shards import feistel_shards
from tallyforge.llm.itq_neighbours import itq_neighbours
from tallyforge.llm.line_quality import line_quality
from tallyforge.llm.piece_offsets import piece_offsets
from tallyforge.llm.oracles import ORACLES
from tallyforge.llm.parity_join import parity_join
from tallyforge.llm.random_secrets import random_secrets
from tallyforge.llm.target_resampling import target_resampling
from tallyforge.llm.tier_packing import tier_packing
from tallyforge.llm.weak_toxicity import weak_toxicity
from tallyforge.session import work_folder


def op1_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_dictionary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary_ids(table(spark, sf_dir, "documents", "doc_id", "text"), work_folder(spark, "ids"))


def op4_random_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return random_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_bitmask_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitmask_language(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_itq_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    return weak_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), labels)


def op11_piece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = piece_offsets(table(spark, sf_dir, "documents", "doc_id", "text"))
    digests = (F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
    return pieces.select("doc_id", "n_tokens", *digests)


def op12_euler_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return euler_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return target_resampling(documents, table(spark, sf_dir, "benchmark", "text")).drop("n_words")


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_quality,
        op2_tier_packing,
        op3_chunk_bpe,
        op4_random_secrets,
        op5_feistel_shards,
        op6_bitmask_language,
        op7_dictionary_ids,
        op8_itq_neighbours,
        op9_parity_join,
        op10_weak_toxicity,
        op11_piece_offsets,
        op12_euler_trie,
        op13_target_resampling,
    )
}
