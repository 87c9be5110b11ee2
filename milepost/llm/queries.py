"""The training-data queries by name, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm.chat import CHAT_SQL, perspectives
from milepost.llm.common import table
from milepost.llm.exact_dedup import exact_duplicates
from milepost.llm.hard_negatives import HARD_NEGATIVES_SQL, hard_negatives
from milepost.llm.lexical_search import SEARCH_SQL, ranked_search
from milepost.llm.line_dedup import dedup_lines
from milepost.llm.lm_scoring import lm_scores
from milepost.llm.mixing import MIX_SQL, mix
from milepost.llm.quality import QUALITY_SQL, quality
from milepost.llm.sentencepiece import decode, encode
from milepost.llm.sharding import shard_documents
from milepost.llm.simhash import near_duplicates
from milepost.llm.suffix_dedup import remove_repeats
from milepost.llm.toxicity import toxicity


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs)).select(
        "doc_id",
        "n_ids",
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws("-", s.start, s.end))
    return perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_exact_lines",
        "n_near_lines",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("text_sha256"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_sentencepiece,
        op3_chat_formatting,
        op4_quality_rules,
        op5_line_dedup,
        op6_mixing,
        op7_sharding,
        op8_exact_dedup,
        op9_toxicity,
        op10_simhash_near_dedup,
        op11_hard_negatives,
        op12_lexical_search,
        op13_lm_scoring,
    )
}

ORACLE: dict[str, str] = {
    "op3_chat_formatting": CHAT_SQL,
    "op4_quality_rules": QUALITY_SQL,
    "op6_mixing": "SELECT doc_id, size, source_size, target, taken FROM ("
    + MIX_SQL.format(documents="documents")
    + ")",
    "op8_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER g = 1 AS kept, sha256(body) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY body ORDER BY length(coalesce(text, '')) DESC, doc_id)
    """,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_lexical_search": SEARCH_SQL,
}
