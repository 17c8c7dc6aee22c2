"""Reporting aggregates over a log table with ``is_anomaly``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import safe_divide
from logloom.schema import ROW_ID

# Fixed values.
ERROR_LEVELS = ["ERROR", "CRITICAL"]
GREEN_BELOW, YELLOW_BELOW = 0.05, 0.15
TOP_SERVICES, TOP_MESSAGES, RECENT = 10, 15, 10
SHOWN_MESSAGE = 120


def _hit():
    return F.col("is_anomaly") == 1


def kpis(logs: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: logs, anomalies, rate, services, errors."""
    services = (
        F.approx_count_distinct("service") if approximate else F.count_distinct("service")
    )
    return logs.agg(
        F.count("*").alias("total_logs"),
        F.count_if(_hit()).alias("anomalies"),
        services.alias("services"),
        F.count_if(F.col("level").isin(ERROR_LEVELS)).alias("errors"),
    ).withColumn("anomaly_rate", safe_divide("anomalies", "total_logs"))


def hourly(logs: DataFrame, aggregates: dict, ts: str = "timestamp") -> DataFrame:
    """Aggregates per hour with empty hours as 0: ``hour`` and the given columns.

    The hours between first and last are made year by year in tasks of their own, so a stray time far
    ahead makes many rows, but no large array.
    """
    hour = F.date_trunc("hour", ts)
    counts = (
        logs.where(F.col(ts).isNotNull())
        .groupBy(hour.alias("hour"))
        .agg(*[a.alias(n) for n, a in aggregates.items()])
    )
    ends = counts.agg(F.min("hour").alias("a"), F.max("hour").alias("b")).where("a IS NOT NULL")
    years = ends.select("a", "b", F.explode(F.sequence(F.year("a"), F.year("b"))).alias("y")).repartition("y")
    january = F.make_timestamp(F.col("y"), *[F.lit(x) for x in (1, 1, 0, 0, 0)])
    december = F.make_timestamp(F.col("y"), *[F.lit(x) for x in (12, 31, 23, 0, 0)])
    hours = F.sequence(F.greatest("a", january), F.least("b", december), F.expr("interval 1 hour"))
    spine = years.select(F.explode(hours).alias("hour"))
    return spine.join(counts, "hour", "left").select(
        "hour", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in aggregates]
    )


def hourly_volume(logs: DataFrame) -> DataFrame:
    return hourly(logs, {"n": F.count("*")})


def hourly_split(logs: DataFrame) -> DataFrame:
    return hourly(
        logs,
        {
            "normal_count": F.count_if(F.col("is_anomaly") == 0),
            "anomaly_count": F.count_if(_hit()),
        },
    )


def level_distribution(logs: DataFrame) -> DataFrame:
    return logs.groupBy("level").agg(F.count("*").alias("n"))


def recent_anomalies(logs: DataFrame, limit: int = RECENT) -> DataFrame:
    return (
        logs.where(_hit())
        .orderBy(F.desc("timestamp"), F.desc(ROW_ID))
        .limit(limit)
        .select("timestamp", "level", "service", "message")
    )


def top_anomalous(logs: DataFrame, column: str, limit: int) -> DataFrame:
    """Most frequent values among anomalies; ties in value order."""
    return (
        logs.where(_hit() & F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(limit)
    )


def top_services(logs: DataFrame, limit: int = TOP_SERVICES) -> DataFrame:
    return top_anomalous(logs, "service", limit)


def top_messages(logs: DataFrame, limit: int = TOP_MESSAGES) -> DataFrame:
    top = top_anomalous(logs, "message", limit)
    return top.withColumn("shown", F.substring("message", 1, SHOWN_MESSAGE))


def anomalies_by_level(logs: DataFrame) -> DataFrame:
    return logs.where(_hit()).groupBy("level").agg(F.count("*").alias("n"))


def service_health(logs: DataFrame) -> DataFrame:
    """Total, anomalies, rate and tier per service."""
    rate = F.col("anomalies") / F.greatest(F.col("total"), F.lit(1))
    return (
        logs.groupBy("service")
        .agg(F.count("*").alias("total"), F.count_if(_hit()).alias("anomalies"))
        .withColumn("rate", rate)
        .withColumn(
            "health",
            F.when(F.col("rate") < GREEN_BELOW, "green")
            .when(F.col("rate") < YELLOW_BELOW, "yellow")
            .otherwise("red"),
        )
    )


def service_anomaly_rate(logs: DataFrame) -> DataFrame:
    """Rate among labelled rows per service, highest first."""
    return (
        logs.groupBy("service")
        .agg(
            F.count("is_anomaly").alias("total"),
            F.coalesce(F.sum("is_anomaly"), F.lit(0)).cast("bigint").alias("anomalies"),
        )
        .withColumn("anomaly_rate", F.try_divide("anomalies", "total"))
        .orderBy(F.desc("anomaly_rate"), "service")
    )


def services(logs: DataFrame) -> DataFrame:
    return logs.select("service").distinct()


def confusion_cells(confusion: DataFrame) -> DataFrame:
    """A confusion row as rows ``(actual, predicted, n)``."""
    cells = [
        ("Normal", "Normal", "true_negatives"),
        ("Normal", "Anomaly", "false_positives"),
        ("Anomaly", "Normal", "false_negatives"),
        ("Anomaly", "Anomaly", "true_positives"),
    ]
    return confusion.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")
                    )
                    for a, p, c in cells
                ]
            )
        )
    )


def latency_rows(latency: DataFrame) -> DataFrame:
    """A latency row as rows ``(percentile, latency_ms)``."""
    return latency.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(p.upper()).alias("percentile"), F.col(p).alias("latency_ms"))
                    for p in ("p50", "p90", "p95", "p99")
                ]
            )
        )
    )
