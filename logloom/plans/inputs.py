"""Inputs derived from the given tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import use_utc
from logloom.sources.readers import spread


# Tables whose rows cost far more to process than to move.
HEAVY_TABLES = {"documents", "pages", "embeddings"}


def table(spark: SparkSession, sf: str, name: str, heavy: bool | None = None) -> DataFrame:
    """A given table; a heavy one is spread over the cores if it is a single piece."""
    use_utc(spark)
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if heavy or (heavy is None and name in HEAVY_TABLES) else df


def logs_of(events: DataFrame) -> DataFrame:
    """A labelled log table from the event table; works on a stream as well."""
    kind, value, user = F.col("event_type"), F.col("value"), F.col("user_id")
    error = kind == "error"
    took = F.regexp_extract("props", "([0-9]+)", 1)
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(error & (value > 100), "CRITICAL")
        .when(error, "ERROR")
        .when(kind == "purchase", "WARNING")
        .when(kind == "signup", "DEBUG")
        .otherwise("INFO")
        .alias("level"),
        F.concat(F.lit("svc-"), (user % 6).cast("string")).alias("service"),
        F.when(user % 3 == 0, "")
        .otherwise(
            F.concat(
                F.lit("10.0."),
                (user % 256).cast("string"),
                F.lit("."),
                (F.col("event_id") % 256).cast("string"),
            )
        )
        .alias("source_ip"),
        F.concat(
            kind,
            F.lit(" user_id="),
            user.cast("string"),
            F.lit(" took "),
            took,
            F.lit("ms /api/v1/"),
            kind,
        ).alias("message"),
        F.when(error & (value > 50), 1).otherwise(0).alias("is_anomaly"),
        (value / (value + 100.0)).alias("score"),
        value.alias("latency_ms"),
    )


def logs(spark: SparkSession, sf: str, heavy: bool = False) -> DataFrame:
    return logs_of(table(spark, sf, "events", heavy))


LOGS = """
logs AS (
  SELECT event_id AS row_id, ts AS "timestamp",
    CASE WHEN event_type = 'error' AND value > 100 THEN 'CRITICAL'
         WHEN event_type = 'error' THEN 'ERROR'
         WHEN event_type = 'purchase' THEN 'WARNING'
         WHEN event_type = 'signup' THEN 'DEBUG' ELSE 'INFO' END AS level,
    'svc-' || CAST(user_id % 6 AS VARCHAR) AS service,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.'
         || CAST(event_id % 256 AS VARCHAR) END AS source_ip,
    event_type || ' user_id=' || CAST(user_id AS VARCHAR) || ' took '
      || regexp_extract(props, '([0-9]+)', 1) || 'ms /api/v1/' || event_type AS message,
    CAST(CASE WHEN event_type = 'error' AND value > 50 THEN 1 ELSE 0 END AS INTEGER) AS is_anomaly,
    value / (value + 100.0) AS score, value AS latency_ms
  FROM events)
"""


def raw_lines_of(logs_: DataFrame) -> DataFrame:
    """Text lines in five shapes, one per log row."""
    t = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    clock = F.date_format("timestamp", "HH:mm:ss")
    rid = F.col("row_id").cast("string")
    shape = F.col("row_id") % 5
    lit = F.lit
    line = (
        F.when(
            shape == 0,
            F.concat(
                t, lit(" ["), "level", lit("] "), "service", lit(": "), "message",
                lit(" (src="), "source_ip", lit(")"),
            ),
        )
        .when(shape == 1, F.concat(t, lit(" ["), F.lower("level"), lit("] "), "message"))
        .when(
            shape == 2,
            F.concat(
                lit("Jan 15 "), clock, lit(" host01 "), "service", lit("["), rid, lit("]: "), "message"
            ),
        )
        .when(
            shape == 3,
            F.concat(
                lit("10.1.2.3 - - [15/Jan/2024:"), clock,
                lit(' +0000] "GET /api/v1/x HTTP/1.1" 200 '), rid,
            ),
        )
        .otherwise(F.concat(lit("## "), "level", lit(" "), "message"))
    )
    return logs_.select("row_id", line.alias("line"))


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    return raw_lines_of(logs(spark, sf, heavy=True))


RAW_LINES = LOGS + """,
raw_lines AS (
  SELECT row_id, CASE row_id % 5
    WHEN 0 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ' [' || level || '] ' || service
         || ': ' || message || ' (src=' || source_ip || ')'
    WHEN 1 THEN strftime("timestamp", '%Y-%m-%d %H:%M:%S') || ' [' || lower(level) || '] ' || message
    WHEN 2 THEN 'Jan 15 ' || strftime("timestamp", '%H:%M:%S') || ' host01 ' || service || '['
         || CAST(row_id AS VARCHAR) || ']: ' || message
    WHEN 3 THEN '10.1.2.3 - - [15/Jan/2024:' || strftime("timestamp", '%H:%M:%S')
         || ' +0000] "GET /api/v1/x HTTP/1.1" 200 ' || CAST(row_id AS VARCHAR)
    ELSE '## ' || level || ' ' || message END AS line
  FROM logs)
"""


def dirty_logs(spark: SparkSession, sf: str) -> DataFrame:
    """The log table with text times and planted faults in every rule."""
    fault = F.col("row_id") % 50
    t = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    none = F.lit(None).cast("string")
    return logs(spark, sf, heavy=True).select(
        "row_id",
        F.when(fault == 0, none)
        .when(fault == 1, "")
        .when(fault == 5, F.concat(F.lit("2019"), F.substring(t, 5, 15)))
        .when(fault == 9, F.concat(F.lit("soon "), t))
        .otherwise(t)
        .alias("timestamp"),
        F.when(fault == 4, "BOGUS")
        .when(fault == 6, none)
        .when(fault == 8, F.lower("level"))
        .otherwise(F.col("level"))
        .alias("level"),
        F.when(fault == 10, none).when(fault == 11, " \t ").otherwise(F.col("service")).alias("service"),
        F.when(fault == 12, none).otherwise(F.col("source_ip")).alias("source_ip"),
        F.when(fault == 2, none)
        .when(fault == 3, "   ")
        .when(fault == 7, F.repeat("message", 400))
        .otherwise(F.col("message"))
        .alias("message"),
        "is_anomaly",
    )


DIRTY = LOGS + """,
dirty AS (
  SELECT row_id,
    CASE row_id % 50 WHEN 0 THEN NULL WHEN 1 THEN ''
      WHEN 5 THEN '2019' || substring(strftime("timestamp", '%Y-%m-%d %H:%M:%S'), 5, 15)
      WHEN 9 THEN 'soon ' || strftime("timestamp", '%Y-%m-%d %H:%M:%S')
      ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    CASE row_id % 50 WHEN 4 THEN 'BOGUS' WHEN 6 THEN NULL WHEN 8 THEN lower(level) ELSE level END AS level,
    CASE row_id % 50 WHEN 10 THEN NULL WHEN 11 THEN ' ' || chr(9) || ' ' ELSE service END AS service,
    CASE row_id % 50 WHEN 12 THEN NULL ELSE source_ip END AS source_ip,
    CASE row_id % 50 WHEN 2 THEN NULL WHEN 3 THEN '   ' WHEN 7 THEN repeat(message, 400)
      ELSE message END AS message,
    is_anomaly
  FROM logs)
"""


def document_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as log rows: the text is the message, exact copies included."""
    minute = F.col("doc_id") % 97
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.timestamp_seconds(F.lit(1704067200) + minute * 60).alias("timestamp"),
        F.col("source").alias("service"),
        F.col("text").alias("message"),
        F.sha2("text", 256).alias("log_hash"),
    )


DOCUMENT_LOGS = """
document_logs AS (
  SELECT doc_id AS row_id, TIMESTAMP '2024-01-01' + to_minutes(doc_id % 97) AS "timestamp",
    source AS service, text AS message, sha256(text) AS log_hash
  FROM documents)
"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Log rows as a prediction log."""
    return logs(spark, sf).select(
        "row_id", "timestamp", "latency_ms", (F.col("is_anomaly") == 1).alias("is_anomaly"), "score"
    )


def failures(spark: SparkSession, sf: str) -> DataFrame:
    """CRITICAL rows stand for failed requests."""
    return logs(spark, sf).where("level = 'CRITICAL'").select("row_id", "timestamp")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Truth, prediction and score per log row."""
    return logs(spark, sf).select(
        "row_id",
        F.col("is_anomaly").alias("y_true"),
        F.col("level").isin("ERROR", "CRITICAL").cast("int").alias("y_pred"),
        "score",
    )


LABELLED = LOGS + """,
labelled AS (
  SELECT row_id, is_anomaly AS y_true,
    CAST(level IN ('ERROR', 'CRITICAL') AS INTEGER) AS y_pred, score FROM logs)
"""


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings as feature rows."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features")
    )
