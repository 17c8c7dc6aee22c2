"""Helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import materialize, scratch_dir, ship_package  # noqa: F401

# Fixed values of the contracts: the white space of ASCII, and what separates words of letters and digits.
SPACE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BATCH_ROWS, BATCH_BYTES = 1000, 16 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and keep Arrow batches of long texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pinned(df: DataFrame, keep: Sequence[str], **columns: Column) -> DataFrame:
    """``keep`` and new columns that are evaluated once a row.

    Catalyst moves a projected expression into the lambda that uses it, where it
    would run once for every array element.  A generated row stops that.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    made = df.select(*keep, F.explode(F.array(row)).alias("_pin"))
    return made.select(*keep, *[F.col(f"_pin.{n}").alias(n) for n in columns])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def modulus_of_crc(column: Column, n: int) -> Column:
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(n))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL of the same result."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add
