"""Queries of the operators that gather figures over the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import lm, neardup
from logloom.llm.common import modulus_of_crc, query, table


@query()
def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document by shared shingles of four words."""
    found = neardup.groups(table(spark, sf_dir, "documents"), k=4)
    return found.select(
        F.col("key").alias("doc_id"), "n_shingles", "component_id", (F.col("key") == F.col("component_id")).alias("kept")
    )


@query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document under a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(modulus_of_crc(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = lm.score(docs.withColumn("held_out", held_out), ~held_out, keep=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
