"""Quality checks, quarantine split and quality report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import is_blank
from logloom.functions.timestamps import to_timestamp_any
from logloom.schema import (
    MAX_MESSAGE_LENGTH,
    MAX_NULL_RATIO,
    MAX_TIMESTAMP_YEAR,
    MIN_TIMESTAMP_YEAR,
    REQUIRED_COLUMNS,
    VALID_LEVELS,
)

# Checks in report order; `log_level` is repaired, the others quarantine.
CHECKS = ["schema", "null_check", "log_level", "timestamp", "message_length"]
_REPAIRED = {"log_level"}


@dataclass
class Validated:
    """Valid rows, quarantined rows (with ``reasons``) and the report rows."""

    valid: DataFrame
    quarantined: DataFrame
    report: DataFrame


def _flags(df: DataFrame, max_length: int, min_year: int, default_year: int, max_year: int) -> dict[str, Column]:
    """One boolean per check whose columns exist.  ``default_year`` completes times without a year."""
    have = dict(df.dtypes)
    flags = {"schema": F.lit(all(c in have for c in REQUIRED_COLUMNS))}
    filled = [~is_blank(F.col(c).cast("string")) for c in ("timestamp", "message") if c in have]
    ok = F.lit(True)
    for f in filled:
        ok = ok & f
    flags["null_check"] = ok
    if "level" in have:
        flags["log_level"] = F.coalesce(F.upper("level").isin(VALID_LEVELS), F.lit(False))
    if "timestamp" in have:
        ts = to_timestamp_any("timestamp", have["timestamp"], default_year=default_year)
        # As an element the year is found once, not for either bound.
        in_range = F.exists(F.array(F.year(ts)), lambda year: year.between(min_year, max_year))
        flags["timestamp"] = F.coalesce(in_range, F.lit(False))
    if "message" in have:
        flags["message_length"] = F.coalesce(F.length("message") <= max_length, F.lit(True))
    return flags


def _repair_level(flags: dict[str, Column]) -> Column:
    return F.when(flags["log_level"], F.col("level")).otherwise(F.lit("INFO"))


def _is_valid(flags: dict[str, Column]) -> Column:
    ok = F.lit(True)
    for name, flag in flags.items():
        if name not in _REPAIRED:
            ok = ok & flag
    return ok


def valid_rows(
    df: DataFrame,
    max_length: int = MAX_MESSAGE_LENGTH,
    min_year: int = MIN_TIMESTAMP_YEAR,
    default_year: int = 1900,
    max_year: int = MAX_TIMESTAMP_YEAR,
) -> DataFrame:
    """Rows that pass every check, the level repaired: a filter and one column."""
    flags = _flags(df, max_length, min_year, default_year, max_year)
    good = df.where(_is_valid(flags))
    return good.withColumn("level", _repair_level(flags)) if "log_level" in flags else good


def quarantined_rows(
    df: DataFrame,
    max_length: int = MAX_MESSAGE_LENGTH,
    min_year: int = MIN_TIMESTAMP_YEAR,
    default_year: int = 1900,
    max_year: int = MAX_TIMESTAMP_YEAR,
) -> DataFrame:
    """Rows that fail a check, with ``reasons`` naming all their failed checks."""
    flags = _flags(df, max_length, min_year, default_year, max_year)
    reasons = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in flags.items()]))
    bad = df.where(~_is_valid(flags)).withColumn("reasons", reasons)
    return bad.withColumn("level", _repair_level(flags)) if "log_level" in flags else bad


def quality_report(
    df: DataFrame,
    max_length: int = MAX_MESSAGE_LENGTH,
    min_year: int = MIN_TIMESTAMP_YEAR,
    default_year: int = 1900,
    max_year: int = MAX_TIMESTAMP_YEAR,
) -> DataFrame:
    """Rows ``(check, passed, failed, pass_rate)`` plus an ``overall`` row.

    One pass: each row is reduced to its flags, and every count is a
    conditional sum of the same aggregate.
    """
    flags = _flags(df, max_length, min_year, default_year, max_year)
    names = [n for n in CHECKS if n in flags]
    marked = df.select(*[flags[n].alias(n) for n in names])
    fails = [F.count_if(~F.col(n)).alias(n) for n in names]
    bad = F.count_if(~_is_valid({n: F.col(n) for n in names})).alias("overall")
    totals = marked.agg(F.count("*").alias("total"), *fails, bad)
    cells = [F.struct(F.lit(n).alias("check"), F.col(n).alias("failed")) for n in [*names, "overall"]]
    rows = totals.select("total", F.explode(F.array(*cells)).alias("cell"))
    passed = F.col("total") - F.col("cell.failed")
    return rows.select(
        "cell.check",
        passed.alias("passed"),
        F.col("cell.failed").alias("failed"),
        F.when(F.col("total") > 0, passed / F.col("total")).otherwise(F.lit(1.0)).alias("pass_rate"),
    )


def validate(
    df: DataFrame,
    max_length: int = MAX_MESSAGE_LENGTH,
    min_year: int = MIN_TIMESTAMP_YEAR,
    default_year: int = 1900,
    max_year: int = MAX_TIMESTAMP_YEAR,
) -> Validated:
    """Split a log table; each part is its own lazy plan over the input."""
    return Validated(
        valid=valid_rows(df, max_length, min_year, default_year, max_year),
        quarantined=quarantined_rows(df, max_length, min_year, default_year, max_year),
        report=quality_report(df, max_length, min_year, default_year, max_year),
    )


def accept_requests(df: DataFrame, max_length: int = MAX_MESSAGE_LENGTH, now: Column | None = None):
    """Scoring requests: keep messages of 1..``max_length`` characters, fill defaults.

    ``now`` fills a missing time and defaults to the query's start time.
    """
    now = F.current_timestamp() if now is None else now
    return df.where(F.length("message").between(1, max_length)).withColumns(
        {
            "timestamp": F.coalesce(F.col("timestamp"), now.cast(dict(df.dtypes)["timestamp"])),
            "level": F.coalesce(F.nullif("level", F.lit("")), F.lit("INFO")),
            "service": F.coalesce(F.nullif("service", F.lit("")), F.lit("unknown")),
            "source_ip": F.coalesce(F.col("source_ip"), F.lit("")),
        }
    )


def date_range(
    df: DataFrame, start=None, end=None, service: str = "All", ts: str = "timestamp"
) -> DataFrame:
    """Rows between two dates, both included, of one service or of all.

    The bounds compare the time itself, so the filter reaches the file scan.
    """
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1))
    if service != "All":
        df = df.where(F.col("service") == service)
    return df


def null_ratios(df: DataFrame, columns: list[str], max_ratio: float = MAX_NULL_RATIO) -> DataFrame:
    """Share of NULLs per column and whether it is within the limit."""
    counts = df.agg(
        F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    ratio = F.coalesce(F.try_divide(F.col("cell.nulls"), F.col("total")), F.lit(0.0))
    return counts.select("total", F.explode(F.array(*cells)).alias("cell")).select(
        "cell.column_name",
        "cell.nulls",
        ratio.alias("null_ratio"),
        (ratio <= max_ratio).alias("within_limit"),
    )
