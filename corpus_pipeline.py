"""The corpus pipeline: documents in, token ids out.

Each stage takes what the stage before kept, as a table read back from Parquet.

Defined results: a document without text fails the quality rules; repeated rows of one document are
judged alike and stay together; a row without a key is no near-duplicate of anything; columns beyond those
the stages read are carried along; empty tables give an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bytebpe, decontaminate, linededup, neardup, quality
from logloom.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take bad lines out; drop documents that fail the rules."""
    return quality.clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines out that ten documents or more share."""
    return linededup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares 0.8 of its shingles of five words."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by benchmark items."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    path = public_tokenizers.path(VOCABULARY)
    tokens = bytebpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "text"))
    done = bytebpe.decode(tokens, path)
    whole = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", whole.alias("round_trip"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"

STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

# SQL can't express signatures with confirmed links or byte-pair merges; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
