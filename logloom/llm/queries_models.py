"""Queries of the operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import langid, urls
from logloom.llm.common import modulus_of_crc, query, table

# Fixed values of the contract.
URL_RULES = [
    ("block", ("net", "/")),
    ("allow", ("example.net", "/en/")),
    ("block", ("example.com", "/de/")),
    ("allow", ("org", "/fr/")),
]


@query()
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network that learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(modulus_of_crc(F.col("doc_id"), 4) == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, keep=("doc_id", "held_out"))
