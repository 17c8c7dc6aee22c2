"""Monitoring over a table of predictions.

A prediction row is ``(timestamp, row_id, latency_ms, is_anomaly, score)``;
failed requests are rows of a separate error table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import safe_divide
from logloom.operators.evaluate import DRIFT_P_VALUE, ks_drift
from logloom.schema import ROW_ID

# Fixed values.
WINDOW_SIZE = 10_000
RATE_SECONDS = 60
MIN_DRIFT_ROWS = 100
LATENCY_PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
THRESHOLDS = {
    "anomaly_rate_warning": 0.10,
    "anomaly_rate_critical": 0.25,
    "latency_p99_ms": 500.0,
    "error_rate": 0.05,
}


def prediction_log(
    scored: DataFrame,
    ts: Column | str = "timestamp",
    latency: Column | str | None = None,
    flag: str = "is_anomaly_detected",
    score: str = "anomaly_score",
) -> DataFrame:
    """Scored rows in the shape the monitoring operators read."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    latency = F.lit(0.0) if latency is None else latency
    latency = F.col(latency) if isinstance(latency, str) else latency
    return scored.select(
        ROW_ID,
        ts.alias("timestamp"),
        latency.cast("double").alias("latency_ms"),
        F.col(flag).cast("boolean").alias("is_anomaly"),
        F.col(score).alias("score"),
    )


def error_events(requests: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Failed requests in the shape the error counters read."""
    return requests.select(ROW_ID, F.col(ts).alias("timestamp"))


def last_rows(
    predictions: DataFrame, n: int = WINDOW_SIZE, ts: str = "timestamp", row_id: str = ROW_ID
) -> DataFrame:
    """The newest ``n`` rows; every task sends at most ``n`` of them."""
    return predictions.orderBy(F.desc(ts), F.desc(row_id)).limit(n)


def rolling_metrics(
    predictions: DataFrame, errors: DataFrame | None = None, window: int = WINDOW_SIZE
) -> DataFrame:
    """One row: totals over everything, and rates over the newest ``window`` rows."""
    flag = F.col("is_anomaly").cast("boolean")
    total = predictions.agg(
        F.count("*").alias("total_predictions"), F.count_if(flag).alias("total_anomalies")
    )
    recent = last_rows(predictions, window).agg(
        F.struct(F.count("*").alias("size"), F.count_if(flag).alias("hits")).alias("w")
    )
    out = total.withColumn("w", recent.scalar())
    failures = F.lit(0).cast("bigint")
    if errors is not None:
        failures = errors.agg(F.count("*").alias("n")).scalar()
    out = out.withColumn("total_errors", failures)
    return out.select(
        "total_predictions",
        "total_anomalies",
        F.col("w.size").alias("window_size"),
        F.col("w.hits").alias("window_anomalies"),
        safe_divide(F.col("w.hits"), F.col("w.size")).alias("window_rate"),
        safe_divide("total_anomalies", "total_predictions").alias("overall_rate"),
        F.coalesce("total_errors", F.lit(0)).alias("total_errors"),
        safe_divide(
            F.coalesce("total_errors", F.lit(0)),
            F.col("total_predictions") + F.coalesce("total_errors", F.lit(0)),
        ).alias("error_rate"),
    )


def latency_statistics(predictions: DataFrame, window: int = WINDOW_SIZE) -> DataFrame:
    """Mean, percentiles and maximum of the newest rows; zeros when there are none.

    ``percentile`` is exact and safe here: the window bounds its input.
    """
    recent = last_rows(predictions, window)
    marks = F.percentile("latency_ms", F.array(*[F.lit(q) for q in LATENCY_PERCENTILES.values()]))
    figures = recent.agg(
        F.avg("latency_ms").alias("mean"), marks.alias("q"), F.max("latency_ms").alias("max")
    )
    zero = F.lit(0.0)
    return figures.select(
        F.coalesce("mean", zero).alias("mean"),
        *[F.coalesce(F.col("q")[i], zero).alias(n) for i, n in enumerate(LATENCY_PERCENTILES)],
        F.coalesce("max", zero).alias("max"),
    )


def score_summary(predictions: DataFrame, window: int = WINDOW_SIZE) -> DataFrame:
    zero = F.lit(0.0)
    return last_rows(predictions, window).agg(
        F.coalesce(F.avg("score"), zero).alias("mean"),
        F.coalesce(F.stddev_pop("score"), zero).alias("std"),
        F.coalesce(F.min("score"), zero).alias("min"),
        F.coalesce(F.max("score"), zero).alias("max"),
    )


def request_rate(
    predictions: DataFrame,
    as_of: Column | None = None,
    seconds: int = RATE_SECONDS,
    window: int = WINDOW_SIZE,
) -> DataFrame:
    """Predictions per second in the ``seconds`` before ``as_of`` (default: the last row)."""
    recent = last_rows(predictions, window)
    if as_of is None:
        as_of = predictions.agg(F.max("timestamp").alias("t")).scalar()
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))
    inside = age.between(0, seconds * 1_000_000 - 1)
    return recent.withColumn("_in", inside).agg(
        F.count_if("_in").alias("requests"),
        (F.count_if("_in") / F.lit(float(seconds))).alias("rate_per_second"),
    )


def alert_rules(thresholds: dict[str, float] | None = None) -> dict[str, float]:
    return {**THRESHOLDS, **(thresholds or {})}


def check_alerts(
    metrics: DataFrame, latency: DataFrame, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """Alerts raised by one metrics row and one latency row: ``(severity, type, value, message)``."""
    t = alert_rules(thresholds)
    row = metrics.select("window_rate", "error_rate").withColumn(
        "p99", latency.select("p99").scalar()
    )
    rate, error, p99 = F.col("window_rate"), F.col("error_rate"), F.col("p99")

    def alert(condition, severity, kind, value, limit, text):
        message = F.format_string(text, value, F.lit(float(limit)))
        return F.when(
            condition,
            F.struct(
                F.lit(severity).alias("severity"),
                F.lit(kind).alias("type"),
                value.cast("double").alias("value"),
                message.alias("message"),
            ),
        )

    critical = rate > t["anomaly_rate_critical"]
    alerts = F.array(
        alert(
            critical,
            "CRITICAL",
            "anomaly_rate",
            rate,
            t["anomaly_rate_critical"],
            "anomaly rate %.4f is above the critical limit %.4f",
        ),
        alert(
            ~critical & (rate > t["anomaly_rate_warning"]),
            "WARNING",
            "anomaly_rate",
            rate,
            t["anomaly_rate_warning"],
            "anomaly rate %.4f is above the warning limit %.4f",
        ),
        alert(
            p99 > t["latency_p99_ms"],
            "WARNING",
            "latency",
            p99,
            t["latency_p99_ms"],
            "p99 latency %.1f ms is above the limit %.1f ms",
        ),
        alert(
            error > t["error_rate"],
            "CRITICAL",
            "error_rate",
            error,
            t["error_rate"],
            "error rate %.4f is above the limit %.4f",
        ),
    )
    return row.select(F.inline(F.array_compact(alerts)))


def drift_check(
    predictions: DataFrame,
    reference: DataFrame | None,
    score: str = "score",
    window: int = WINDOW_SIZE,
    threshold: float = DRIFT_P_VALUE,
    cuts=None,
) -> DataFrame | None:
    """Drift of the newest scores; no row below 100 scores, None without a reference."""
    if reference is None:
        return None
    recent = last_rows(predictions, window)
    return ks_drift(reference, recent, score, threshold, cuts).where(
        F.col("current_n") >= MIN_DRIFT_ROWS
    )


def metric_lines(
    metrics: DataFrame, latency: DataFrame, prefix: str = "logloom", text: bool = False
) -> DataFrame:
    """Rows ``(position, name, type, help, value)``; ``text`` adds the exposition lines."""
    row = metrics.withColumn(
        "_l", latency.select(F.struct("mean", "p99").alias("l")).scalar()
    )
    spec = [
        ("predictions_total", "counter", "Log rows scored so far", F.col("total_predictions"), "%.0f"),
        ("anomalies_total", "counter", "Rows scored as anomalous so far", F.col("total_anomalies"), "%.0f"),
        ("anomaly_rate", "gauge", "Share of anomalous rows in the window", F.col("window_rate"), "%.6f"),
        ("latency_avg_ms", "gauge", "Mean scoring time in the window, milliseconds", F.col("_l.mean"), "%.2f"),
        ("latency_p99_ms", "gauge", "99th percentile of scoring time in the window, milliseconds", F.col("_l.p99"), "%.2f"),
        ("errors_total", "counter", "Rows that could not be scored so far", F.col("total_errors"), "%.0f"),
    ]
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f"{prefix}_{name}").alias("name"),
                F.lit(kind).alias("type"),
                F.lit(help_).alias("help"),
                value.cast("double").alias("value"),
                F.format_string(fmt, value.cast("double")).alias("shown"),
            )
            for i, (name, kind, help_, value, fmt) in enumerate(spec)
        ]
    )
    out = row.select(F.inline(cells))
    if not text:
        return out.drop("shown")
    line = F.concat_ws(
        "\n",
        F.concat_ws(" ", F.lit("# HELP"), "name", "help"),
        F.concat_ws(" ", F.lit("# TYPE"), "name", "type"),
        F.concat_ws(" ", "name", "shown"),
    )
    return out.withColumn("line", line).drop("shown")
