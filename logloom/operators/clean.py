"""Cleaning: times, message text, missing values, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import text as tx
from logloom.functions import timestamps as tm
from logloom.operators.dedup import deduplicate
from logloom.schema import IMPUTE_DEFAULTS
from logloom.session import materialize


def normalize_timestamps(
    df: DataFrame, default_year: int = 1900, fill: Column | None = None
) -> DataFrame:
    """Parse ``timestamp``, keeping the text as ``timestamp_raw``.

    A time that cannot be parsed is NULL unless ``fill`` is given.
    """
    dtype = dict(df.dtypes)["timestamp"]
    ts = tm.to_timestamp_any("timestamp", dtype, **({"default_year": default_year} if dtype == "string" else {}))
    if fill is not None:
        ts = F.coalesce(ts, fill)
    return df.withColumns({"timestamp_raw": F.col("timestamp").cast("string"), "timestamp": ts})


def clean_messages(df: DataFrame, **options) -> DataFrame:
    return df.withColumn("message", tx.clean_message("message", **options))


def impute(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """NULL or blank cells take the column's default."""
    defaults = IMPUTE_DEFAULTS if defaults is None else defaults
    return df.withColumns(
        {
            c: F.when(tx.is_blank(c), F.lit(v)).otherwise(F.col(c))
            for c, v in defaults.items()
            if c in df.columns
        }
    )


def derive(df: DataFrame) -> DataFrame:
    """Add length, severity code, calendar fields and the address flag."""
    out = {
        "message_length": F.length("message"),
        "level_numeric": tx.level_numeric("level"),
        "hour_of_day": tm.hour_of_day("timestamp"),
        "day_of_week": tm.day_of_week("timestamp"),
        "is_business_hours": tm.is_business_hours("timestamp"),
        "has_ip": (~tx.is_blank("source_ip") & (F.col("source_ip") != "0.0.0.0")).cast("int"),
    }
    need = {
        "message_length": "message",
        "level_numeric": "level",
        "has_ip": "source_ip",
    }
    return df.withColumns({k: v for k, v in out.items() if need.get(k, "timestamp") in df.columns})


def preprocess(
    df: DataFrame,
    dedup: bool = True,
    window_minutes: int | None = None,
    default_year: int = 1900,
    fill_timestamp: Column | None = None,
    **message_options,
) -> DataFrame:
    """Times, text, de-duplication, imputation, derived columns.

    De-duplication reads its rows twice, for their keys and for themselves: they are written once before it.
    """
    df = normalize_timestamps(df, default_year, fill_timestamp)
    df = clean_messages(df, **message_options)
    if dedup:
        df = deduplicate(materialize(df, "normalized"), window_minutes=window_minutes)
    return derive(impute(df))
