"""Per-row features: text statistics, templates, time windows, frequencies.

Every figure that depends on other rows is taken from a table of counts.  The
table is counted from the batch and written once, so that its size is known and
no later use counts again, or it is passed in (``stats=``), as for a saved
training table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions import text as tx
from logloom.functions.templates import template
from logloom.functions.timestamps import day_of_week, hour_of_day, window_start
from logloom.operators.lookup import lookup
from logloom.operators.ordered import previous_time_gap
from logloom.schema import ROW_ID
from logloom.session import materialize

# Fixed values.
WINDOW_MINUTES = [1, 5, 15, 60]
MAX_TEMPLATES = 500
STATISTICAL = [
    "message_length",
    "level_numeric",
    "hour_of_day",
    "day_of_week",
    "has_ip",
    "word_count",
    "special_char_ratio",
    "uppercase_ratio",
]
FREQUENCY = ["service_frequency", "service_rarity", "level_rarity_in_service", "ip_frequency"]


def time_feature_names(sizes: Sequence[int] = WINDOW_MINUTES) -> list[str]:
    return [f"log_count_{m}min" for m in sizes] + ["inter_arrival_seconds"]


# --- statistics of the row itself ---------------------------------------------


def statistical_features(df: DataFrame) -> DataFrame:
    """``row_id`` and the eight columns that need only the row."""
    return df.select(ROW_ID, *statistical_columns(df))


def statistical_columns(df: DataFrame) -> list[Column]:
    """Length, severity, calendar and character figures; a column present is used."""
    have = set(df.columns)
    message = F.coalesce(F.col("message"), F.lit(""))

    def given(name: str, otherwise, default):
        value = F.col(name) if name in have else otherwise
        return F.coalesce(value, F.lit(default)).alias(name)

    timed = "timestamp" in have
    return [
        given("message_length", F.length(message), 0),
        given("level_numeric", tx.level_numeric("level") if "level" in have else F.lit(1), 1),
        given("hour_of_day", hour_of_day("timestamp") if timed else F.lit(12), 12),
        given("day_of_week", day_of_week("timestamp") if timed else F.lit(0), 0),
        given("has_ip", F.lit(0), 0),
        tx.word_count(message).alias("word_count"),
        tx.special_char_ratio(message).alias("special_char_ratio"),
        tx.uppercase_ratio(message).alias("uppercase_ratio"),
    ]


# --- templates ----------------------------------------------------------------


def with_template(df: DataFrame, substitutions=None) -> DataFrame:
    if "template" in df.columns:
        return df
    return df.withColumn(
        "template", template(F.coalesce(F.col("message"), F.lit("")), substitutions)
    )


def template_counts(df: DataFrame) -> DataFrame:
    return with_template(df).groupBy("template").agg(F.count("*").alias("n"))


def template_vocabulary(counts: DataFrame, max_templates: int = MAX_TEMPLATES) -> DataFrame:
    """The most frequent templates with ids in name order: at most ``max_templates`` rows."""
    top = counts.orderBy(F.desc("n"), "template").limit(max_templates)
    return top.select(
        "template",
        (F.row_number().over(Window.orderBy("template")) - 1).alias("template_id"),
        "n",
    )


def template_features(
    df: DataFrame,
    vocabulary: DataFrame | None = None,
    stats: DataFrame | None = None,
    max_templates: int = MAX_TEMPLATES,
) -> DataFrame:
    """``template_id`` (-1 outside the vocabulary) and ``template_rarity``.

    Counts come from ``stats`` if given; a template not seen there counts once.
    The ids join onto the count table first, so the rows are joined only once.
    """
    rows = with_template(df).select(ROW_ID, "template")
    counts = materialize(template_counts(rows), "counts") if stats is None else stats
    if vocabulary is None:
        vocabulary = template_vocabulary(counts, max_templates)
    ids = vocabulary.select("template", "template_id")
    table = counts.join(F.broadcast(ids), "template", "left").withColumn(
        "template_id", F.coalesce("template_id", F.lit(-1))
    )
    total = counts.agg(F.sum("n").alias("total"))
    out = lookup(rows, table, ["template"], {"template_id": -1, "n": 1})
    rarity = 1.0 - F.col("n") / total.scalar()
    return out.select(ROW_ID, "template_id", rarity.alias("template_rarity"))


# --- time ---------------------------------------------------------------------


def window_counts(df: DataFrame, sizes: Sequence[int] = WINDOW_MINUTES, ts: str = "timestamp"):
    """Rows per tumbling window of every size, keyed by the finest window.

    All sizes are whole multiples of their greatest common divisor, so the rows
    are counted once, and the larger windows are sums over that short table.
    """
    base = reduce(math.gcd, sizes)
    fine = (
        df.select(window_start(ts, base).alias("minute"))
        .where("minute IS NOT NULL")
        .groupBy("minute")
        .agg(F.count("*").alias("n"))
    )
    sums = {}
    for m in sizes:
        key = F.col("minute") - F.pmod(F.col("minute"), F.lit(m))
        sums[f"log_count_{m}min"] = F.sum("n").over(Window.partitionBy(key))
    return fine.withColumns(sums)


def time_features(
    df: DataFrame,
    sizes: Sequence[int] = WINDOW_MINUTES,
    stats: DataFrame | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Counts of the row's own windows and seconds since the row before."""
    base = reduce(math.gcd, sizes)
    rows = df.select(ROW_ID, F.col(ts), window_start(ts, base).alias("minute"))
    table = materialize(window_counts(df, sizes, ts), "counts") if stats is None else stats
    names = [f"log_count_{m}min" for m in sizes]
    counted = lookup(rows, table, ["minute"], dict.fromkeys(names, 0))
    gaps = previous_time_gap(df, ts)
    return counted.join(gaps, ROW_ID, "left").select(
        ROW_ID,
        *names,
        F.coalesce("inter_arrival_seconds", F.lit(0.0)).alias("inter_arrival_seconds"),
    )


def window_statistics(df: DataFrame, minutes: int, columns: Sequence[str], ts: str = "timestamp"):
    """Count, mean, population sd and maximum of columns per tumbling window."""
    start = F.timestamp_seconds(window_start(ts, minutes) * 60)
    aggs = [F.count("*").alias("n")]
    for c in columns:
        aggs += [
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_pop(c).alias(f"{c}_std"),
            F.max(c).alias(f"{c}_max"),
        ]
    return df.where(F.col(ts).isNotNull()).groupBy(start.alias("window_start")).agg(*aggs)


# --- frequencies ----------------------------------------------------------------


def service_level_counts(df: DataFrame) -> DataFrame:
    """Rows per (service, level) with the service's total beside it."""
    pairs = df.groupBy("service", "level").agg(F.count("*").alias("n"))
    totals = pairs.groupBy("service").agg(F.sum("n").alias("service_n"))
    return pairs.join(totals, "service")


def service_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("service").agg(F.count("*").alias("n"))


def ip_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_ip").agg(F.count("*").alias("n"))


def service_frequency(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    table = materialize(service_counts(df), "counts") if stats is None else stats
    total = table.agg(F.sum("n").alias("total"))
    out = lookup(df.select(ROW_ID, "service"), table, ["service"], {"n": 0})
    freq = F.col("n") / total.scalar()
    return out.select(
        ROW_ID, freq.alias("service_frequency"), (1.0 - freq).alias("service_rarity")
    )


def level_rarity(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """1 - share of the row's level among its service; 0.5 for an unseen pair."""
    table = materialize(service_level_counts(df), "counts") if stats is None else stats
    table = table.withColumn("level_rarity_in_service", 1.0 - F.col("n") / F.col("service_n"))
    out = lookup(
        df.select(ROW_ID, "service", "level"),
        table,
        ["service", "level"],
        {"level_rarity_in_service": 0.5},
    )
    return out.select(ROW_ID, "level_rarity_in_service")


def ip_frequency(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    table = materialize(ip_counts(df), "counts") if stats is None else stats
    total = table.agg(F.sum("n").alias("total"))
    out = lookup(df.select(ROW_ID, "source_ip"), table, ["source_ip"], {"n": 0})
    return out.select(ROW_ID, (F.col("n") / total.scalar()).alias("ip_frequency"))
