"""Sources, stateful operators, scoring, alerts and sinks of log streams.

Parsing, validation, cleaning and the row-level features are projections and
filters, so the batch functions run on a stream unchanged.  This module adds
what differs: state bounded by a watermark, scoring from fitted tables, and
sinks that repeat nothing after a restart.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from logloom.functions.parsing import LinePattern, parse_lines
from logloom.functions.text import strip
from logloom.functions.timestamps import to_timestamp_any
from logloom.operators.clean import clean_messages, derive, impute, normalize_timestamps
from logloom.operators.evaluate import ScoreReference
from logloom.operators.validate import quarantined_rows, valid_rows
from logloom.schema import ROW_ID
from logloom.sources.store import write_text

# Micro-batch settings and the alert threshold.
BATCH_SECONDS = 5
BATCH_FILES = 100
DETECTION_THRESHOLD = 0.5
HEURISTIC_LEVELS = ["ERROR", "CRITICAL"]
HEURISTIC_SHARE = 0.3


# --- sources --------------------------------------------------------------------


def read_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: T.StructType | None = None,
    max_files: int = BATCH_FILES,
) -> DataFrame:
    """Files arriving in a folder; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", max_files)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def lines_of(events: DataFrame) -> DataFrame:
    """``line`` from a ``value`` column, text or bytes as a message broker delivers it."""
    return events.select(
        *[c for c in events.columns if c != "value"],
        strip(F.col("value").cast("string")).alias("line"),
    ).where(F.col("line") != "")


def parse_stream(lines: DataFrame, patterns: list[LinePattern] | None = None) -> DataFrame:
    return parse_lines(lines, "line", patterns)


def clean_stream(logs: DataFrame, default_year: int = 1900) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows); stateless."""
    good = normalize_timestamps(valid_rows(logs, default_year=default_year), default_year)
    return derive(impute(clean_messages(good))), quarantined_rows(logs, default_year=default_year)


def with_event_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Watermarks need TIMESTAMP; text and zone-less times are converted."""
    return df.withColumn(ts, to_timestamp_any(ts, dict(df.dtypes)[ts]))


# --- stateful -------------------------------------------------------------------


def deduplicate_stream(
    df: DataFrame, keys: list[str], delay: str = "10 minutes", ts: str = "timestamp"
) -> DataFrame:
    """First row per key within the watermark delay; older keys leave the state."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def window_rates(
    df: DataFrame,
    size: str = "5 minutes",
    slide: str | None = None,
    delay: str = "10 minutes",
    keys: list[str] | None = None,
    flag: Column | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Rows, anomalies and rate per window; a window is emitted once it is closed.

    Counts are combined before the shuffle, so a busy key costs one row per task.
    """
    flag = F.col("is_anomaly_detected") if flag is None else flag
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.withWatermark(ts, delay)
        .groupBy(window.alias("w"), *(keys or []))
        .agg(F.count("*").alias("n"), F.count_if(flag).alias("anomalies"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *(keys or []),
            "n",
            "anomalies",
            (F.col("anomalies") / F.col("n")).alias("anomaly_rate"),
        )
    )


# --- scoring --------------------------------------------------------------------


def score_stream(
    df: DataFrame,
    scoring: Callable[[DataFrame], DataFrame],
    threshold: float = DETECTION_THRESHOLD,
) -> DataFrame:
    """Apply a function that adds ``anomaly_score``; above ``threshold`` is detected."""
    return scoring(df).withColumn("is_anomaly_detected", F.col("anomaly_score") > threshold)


def model_scoring(detector, features: Callable[[DataFrame], DataFrame]):
    """Scoring function of a trained detector on features of the row itself.

    ``features`` adds the ``features`` column; scores use the training range, so
    a row's score does not depend on the micro-batch it arrives in.
    """

    def run(df: DataFrame) -> DataFrame:
        return detector.score(features(df), bounds="fitted").drop("is_anomaly_detected")

    return run


def heuristic_scores(
    df: DataFrame, share: float = HEURISTIC_SHARE, row_id: str = ROW_ID
) -> DataFrame:
    """Scores without a model: a fixed ``share`` of ERROR and CRITICAL rows is flagged.

    The choice and the score come from a hash of the row key, so a replayed
    micro-batch gives the same result.  Flagged rows score 0.6..0.95, others
    0.01..0.4.
    """
    digest = F.sha2(F.col(row_id).cast("string"), 256)

    def draw(start: int) -> Column:
        return F.conv(F.substring(digest, start, 6), 16, 10).cast("bigint") / F.lit(float(16**6))

    hit = F.coalesce(F.col("level").isin(HEURISTIC_LEVELS), F.lit(False)) & (draw(1) < share)
    spread = draw(7)
    return df.withColumn(
        "anomaly_score", F.when(hit, 0.6 + 0.35 * spread).otherwise(0.01 + 0.39 * spread)
    ).withColumn("is_anomaly_detected", hit)



# --- sinks ----------------------------------------------------------------------


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    mode: str = "append",
    fmt: str = "parquet",
):
    """Start the query; the file sink commits a micro-batch at most once."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True)
        if available_now
        else writer.trigger(processingTime=f"{BATCH_SECONDS} seconds")
    )
    return writer.start(path)


def write_scored_and_alerts(
    scored: DataFrame,
    scored_path: str,
    alerts_path: str,
    checkpoint: str,
    available_now: bool = False,
    fail_after: int | None = None,
):
    """Write every scored row and, separately, the detections.

    Each micro-batch owns one folder per sink and overwrites it, so a batch
    that is replayed after a failure leaves no second copy.  ``fail_after`` names a micro-batch
    that fails after its writes, to try that out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{scored_path}/batch_id={batch_id}")
        written = batch.sparkSession.read.schema(batch.schema).parquet(
            f"{scored_path}/batch_id={batch_id}"
        )
        written.where("is_anomaly_detected").write.mode("overwrite").parquet(
            f"{alerts_path}/batch_id={batch_id}"
        )
        if batch_id == fail_after:
            raise RuntimeError(f"micro-batch {batch_id} fails as asked")

    writer = scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True)
        if available_now
        else writer.trigger(processingTime=f"{BATCH_SECONDS} seconds")
    )
    return writer.start()


def write_drift(
    scores: DataFrame,
    reference: ScoreReference | DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
):
    """Compare each micro-batch of scores with a fixed reference; one row per batch.

    Raw reference scores are counted once, into a table beside the checkpoint.
    """
    if isinstance(reference, DataFrame):
        reference = ScoreReference.build(reference, f"{checkpoint}-reference")

    def write(batch: DataFrame, batch_id: int) -> None:
        result = reference.drift(batch).where("current_n > 0")
        result.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}"
        )

    writer = scores.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def running_totals(scored: DataFrame) -> DataFrame:
    """Rows seen and detections so far, kept as two counters (complete mode)."""
    return scored.groupBy().agg(
        F.count("*").alias("consumed"),
        F.count_if("is_anomaly_detected").alias("anomalies_detected"),
    )


def observed_totals(scored: DataFrame, name: str = "totals") -> DataFrame:
    """The same figures per micro-batch in the query's progress events."""
    return scored.observe(
        name,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if("is_anomaly_detected").alias("anomalies_detected"),
    )


class TotalsListener(StreamingQueryListener):
    """Keeps the observed figures of every micro-batch, and the rows a watermark dropped, in a folder.

    One small file per (query, micro-batch), replaced when the micro-batch is repeated: totals hold over any number of
    micro-batches and restarts, while a query's own list of progress events is short.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "totals") -> None:
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        figures = row.asDict() if row is not None else {}
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        body = {"query_id": str(progress.id), "batch_id": progress.batchId, "rows": progress.numInputRows, "late_rows": dropped}
        write_text(self.spark, f"{self.path}/{progress.id}-{progress.batchId}.json", json.dumps(body | {"figures": figures}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_TOTALS = "query_id string, batch_id bigint, rows bigint, late_rows bigint, figures map<string, bigint>"


def recorded_totals(spark: SparkSession, path: str, query_id: str | None = None) -> DataFrame:
    """Per query: micro-batches, rows read, rows dropped as late, and the observed figures."""
    rows = spark.read.schema(_TOTALS).json(path)
    if query_id is not None:
        rows = rows.where(F.col("query_id") == query_id)
    figures = {c: F.coalesce(F.sum(F.col("figures")[c]), F.lit(0)).alias(c) for c in ("consumed", "anomalies_detected")}
    return rows.groupBy("query_id").agg(
        F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.sum("late_rows").alias("late_rows"), *figures.values()
    )
