"""Streaming queries: each drains the given files as a stream into a table and reads it back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logloom.models.registry import train
from logloom.operators.assemble import FeatureModel
from logloom.operators.evaluate import ScoreReference
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.plans.queries_ingest import CLEAN_SQL, HAS_IP, LEVEL_CODE, imputed_sql, parsed_sql
from logloom.session import materialize, scratch_dir
from logloom.streaming import model_stream as ms
from logloom.streaming import streams as st
from logloom.streaming.keep_first import keep_first_stream


def event_stream(spark, sf):
    """The event table as a stream of files."""
    schema = src.table(spark, sf, "events").schema
    return st.read_stream(spark, f"{sf}/events*.parquet", "parquet", schema)


def log_stream(spark, sf):
    return src.logs_of(event_stream(spark, sf))


def drain(df, purpose: str, mode: str = "append"):
    """Run the stream over what is there, then read the sink."""
    spark = df.sparkSession
    base = scratch_dir(spark, purpose)
    started = st.write_stream(df, f"{base}/out", f"{base}/state", available_now=True, mode=mode)
    started.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


@query(
    f"""WITH {src.RAW_LINES} SELECT row_id, "timestamp", level, service, source_ip, message,
    parse_method FROM ({parsed_sql('raw_lines', 'row_id')})"""
)
def stream_parse(spark, sf):
    lines = src.raw_lines_of(log_stream(spark, sf)).withColumnRenamed("line", "value")
    parsed = st.parse_stream(st.lines_of(lines))
    kept = parsed.select(
        "row_id", "timestamp", "level", "service", "source_ip", "message", "parse_method"
    )
    return drain(kept, "stream-parse")


_CLEANED = f"""SELECT row_id, t, level, {imputed_sql('service', 'unknown')}, {imputed_sql('source_ip', '0.0.0.0')},
    {CLEAN_SQL.replace('text', 'message')} AS message FROM (SELECT *, CASE parse_method
      WHEN 'app_log' THEN strptime("timestamp", '%Y-%m-%d %H:%M:%S')
      WHEN 'syslog' THEN strptime('2024 ' || "timestamp", '%Y %b %d %H:%M:%S')
      ELSE strptime(substring("timestamp", 1, 20), '%d/%b/%Y:%H:%M:%S') END AS t FROM p WHERE parse_method <> 'fallback')"""


@query(
    f"""WITH {src.RAW_LINES}, p AS ({parsed_sql('raw_lines', 'row_id')}), c AS ({_CLEANED})
    SELECT row_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS "timestamp", level, service, source_ip, message,
      CAST(length(message) AS INTEGER) AS message_length, {LEVEL_CODE} AS level_numeric, CAST(hour(t) AS INTEGER) AS hour_of_day,
      {HAS_IP} FROM c"""
)
def stream_clean(spark, sf):
    """Lines parsed, checked, repaired and cleaned on a stream; lines without a time are set aside."""
    lines = src.raw_lines_of(log_stream(spark, sf)).withColumnRenamed("line", "value")
    good, _ = st.clean_stream(st.parse_stream(st.lines_of(lines)), default_year=2024)
    kept = good.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).select(
        "row_id", "timestamp", "level", "service", "source_ip", "message", "message_length", "level_numeric", "hour_of_day", "has_ip"
    )
    return drain(kept, "stream-clean")


WINDOWED = """
  w AS (SELECT time_bucket(INTERVAL {slide}, "timestamp") - {back} AS a, is_anomaly FROM logs{expand}),
  closed AS (SELECT * FROM w WHERE a + INTERVAL {size}
    <= (SELECT date_trunc('milliseconds', max("timestamp")) FROM logs) - INTERVAL 10 MINUTE)
  SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
    CAST(count_if(is_anomaly = 1) AS BIGINT) AS anomalies,
    round(count_if(is_anomaly = 1) / count(*), 6) AS anomaly_rate FROM closed GROUP BY 1"""


def _windows(spark, sf, size, slide, purpose):
    rates = st.window_rates(log_stream(spark, sf), size, slide, flag=F.col("is_anomaly") == 1)
    out = drain(rates, purpose)
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "n",
        "anomalies",
        F.round("anomaly_rate", 6).alias("anomaly_rate"),
    )


@query(
    f"WITH {src.LOGS},"
    + WINDOWED.format(slide="1 HOUR", size="1 HOUR", back="INTERVAL 0 HOUR", expand="")
)
def stream_window_counts(spark, sf):
    """Hourly counts; the windows still open at the end are not emitted."""
    return _windows(spark, sf, "1 hour", None, "stream-windows")


@query(
    f"WITH {src.LOGS},"
    + WINDOWED.format(
        slide="30 MINUTE", size="1 HOUR", back="k * INTERVAL 30 MINUTE",
        expand=", range(0, 2) AS g(k)",
    )
)
def stream_sliding_counts(spark, sf):
    """One-hour windows every half hour."""
    return _windows(spark, sf, "1 hour", "30 minutes", "stream-sliding")


@query(
    f"""WITH {src.LOGS} SELECT service, source_ip FROM logs GROUP BY 1, 2"""
)
def stream_dedup(spark, sf):
    """First row per (service, address) within a watermark longer than the data."""
    rows = st.deduplicate_stream(log_stream(spark, sf), ["service", "source_ip"], "60 days")
    return drain(rows.select("service", "source_ip"), "stream-dedup")


HEURISTIC = f"""WITH {src.LOGS}, d AS (SELECT row_id, level, sha256(CAST(row_id AS VARCHAR)) AS h FROM logs),
  u AS (SELECT row_id, level, CAST('0x' || substring(h, 1, 6) AS BIGINT) / 16777216.0 AS a,
    CAST('0x' || substring(h, 7, 6) AS BIGINT) / 16777216.0 AS b FROM d),
  s AS (SELECT row_id, b, level IN ('ERROR', 'CRITICAL') AND a < 0.3 AS is_anomaly_detected FROM u)
  SELECT row_id, round(CASE WHEN is_anomaly_detected THEN 0.6 + 0.35 * b ELSE 0.01 + 0.39 * b END, 6)
    AS anomaly_score, is_anomaly_detected FROM s"""


@query(HEURISTIC)
def heuristic_scores(spark, sf):
    rows = st.heuristic_scores(src.logs(spark, sf))
    return rows.select("row_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly_detected")


@query(HEURISTIC + " WHERE is_anomaly_detected")
def stream_alerts(spark, sf):
    """Detections of the heuristic, routed to the alert sink."""
    scored = st.heuristic_scores(log_stream(spark, sf)).select(
        "row_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly_detected"
    )
    base = scratch_dir(spark, "stream-alerts")
    st.write_scored_and_alerts(
        scored, f"{base}/scored", f"{base}/alerts", f"{base}/state", available_now=True
    ).awaitTermination()
    return spark.read.parquet(f"{base}/alerts").select(*scored.columns)


@query(
    f"""WITH {src.LOGS} SELECT row_id, round(score, 6) AS anomaly_score, score > 0.5 AS is_anomaly_detected
    FROM logs"""
)
def stream_scores(spark, sf):
    """A scoring function applied to a stream."""
    scored = st.score_stream(
        log_stream(spark, sf), lambda df: df.withColumn("anomaly_score", F.col("score"))
    )
    kept = scored.select(
        "row_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly_detected"
    )
    return drain(kept, "stream-scores")


@query(
    f"""WITH {src.LOGS} SELECT count(*) AS consumed,
    CAST(count_if(score > 0.5) AS BIGINT) AS anomalies_detected FROM logs"""
)
def stream_totals(spark, sf):
    """Running totals; the last complete result is the total over the stream."""
    scored = log_stream(spark, sf).withColumn("is_anomaly_detected", F.col("score") > 0.5)
    base = scratch_dir(spark, "stream-totals")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    (
        st.running_totals(scored)
        .writeStream.outputMode("complete")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    rows = spark.read.parquet(f"{base}/out")
    return rows.agg(
        F.max("consumed").alias("consumed"), F.max("anomalies_detected").alias("anomalies_detected")
    )


DRIFT_DAYS = "least(floor(date_diff('day', DATE '2024-01-01', CAST(\"timestamp\" AS DATE)) / 10), 2)"


@query(
    f"""WITH {src.LOGS}, r AS (SELECT score FROM logs WHERE "timestamp" < TIMESTAMP '2024-01-16'),
    b AS (SELECT CAST({DRIFT_DAYS} AS INTEGER) AS batch, score FROM logs),
    v AS (SELECT batch, score, sum(x) AS n, sum(y) AS m FROM (SELECT batch, score, 0 AS x, 1 AS y FROM b
      UNION ALL SELECT k, score, 1, 0 FROM r, (SELECT DISTINCT batch AS k FROM b)) GROUP BY batch, score),
    t AS (SELECT batch, sum(n) AS n, sum(m) AS m FROM v GROUP BY batch),
    g AS (SELECT batch, sum(n) OVER w AS cn, sum(m) OVER w AS cm FROM v WINDOW w AS (PARTITION BY batch ORDER BY score))
    SELECT batch, CAST(any_value(t.n) AS BIGINT) AS reference_n, CAST(any_value(t.m) AS BIGINT) AS current_n,
      round(max(abs(cn / t.n - cm / t.m)), 6) AS statistic FROM g JOIN t USING (batch) GROUP BY batch"""
)
def stream_drift(spark, sf):
    """Three deliveries of scores, each against the scores of the first half, saved as counts."""
    logs = src.logs(spark, sf)
    reference = logs.where(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp"))
    base = scratch_dir(spark, "stream-drift")
    part = F.least(F.floor(F.datediff("timestamp", F.lit("2024-01-01").cast("date")) / 10), F.lit(2))
    scores = arriving(logs.select("timestamp", "score"), "scores", part, 3).select("score")
    saved = ScoreReference.build(reference, f"{base}/reference")
    st.write_drift(scores, saved, f"{base}/out", f"{base}/state", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{base}/out")
    return rows.select("batch", "reference_n", "current_n", F.round("statistic", 6).alias("statistic"))


HALFWAY = "2024-01-16"


def arriving(rows, purpose: str, part, n: int):
    """Rows written as ``n`` deliveries, one after the other, and the stream that takes one at a time."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, purpose)
    rows = materialize(rows.withColumn("_part", part), purpose)
    for i in range(n):
        rows.where(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(path)
    return st.read_stream(spark, path, "parquet", rows.drop("_part").schema, max_files=1)


@query(
    f"""WITH {src.LOGS}, late AS (SELECT * FROM logs WHERE "timestamp" >= TIMESTAMP '{HALFWAY}')
    SELECT row_id, {", ".join(
        f'count(*) OVER (PARTITION BY time_bucket(INTERVAL {m} MINUTE, "timestamp")) AS log_count_{m}min' for m in (1, 5, 15, 60))},
    TRUE AS same_score FROM late"""
)
def stream_model_scores(spark, sf):
    """The fitted feature model and a forest on a stream of five deliveries, against the same rows scored as one batch.

    Every seventh row comes one delivery late.
    """
    logs = src.logs(spark, sf, heavy=True)
    halfway = F.lit(HALFWAY).cast("timestamp")
    old, new = logs.where(F.col("timestamp") < halfway), logs.where(F.col("timestamp") >= halfway)
    features = FeatureModel.fit(old)
    detector = train(materialize(features.transform(old, stats="training"), "feature-rows"), size=len(features.names))

    day = F.datediff("timestamp", halfway)
    part = F.least(F.floor(day / 4) + F.when(F.col("row_id") % 7 == 0, 1).otherwise(0), F.lit(4))
    base = scratch_dir(spark, "stream-model")
    scoring = ms.ModelStream(features, detector, base, delay_minutes=8 * 24 * 60)
    stream = arriving(new, "deliveries", part, 5)
    ms.write_model_scores(stream, scoring, f"{base}/state", available_now=True).awaitTermination()
    scoring.finish(spark)

    batch = materialize(features.transform(new, stats="fitted"), "batch-features")
    want = detector.score(batch, bounds="fitted").select("row_id", F.col("anomaly_score").alias("batch_score"))
    counts = features.dense(new, stats="fitted")
    got = ms.model_scores(spark, base).select("row_id", "anomaly_score")
    names = [f"log_count_{m}min" for m in features.sizes]
    same = F.abs(F.col("anomaly_score") - F.col("batch_score")) < 1e-9
    return got.join(want, "row_id").join(counts, "row_id").select(
        "row_id", *[F.col(c).cast("bigint").alias(c) for c in names], same.alias("same_score")
    )


@query(
    f"""WITH {src.DOCUMENT_LOGS} SELECT row_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", log_hash
    FROM document_logs QUALIFY row_number() OVER (PARTITION BY log_hash ORDER BY "timestamp", row_id) = 1"""
)
def stream_keep_first(spark, sf):
    """Documents in shuffled deliveries: the earliest row of every hash, whichever arrives first."""
    rows = src.document_logs(spark, sf).select("row_id", "timestamp", "log_hash")
    # Two rows far ahead close the time of all others.
    ahead = F.make_timestamp(F.lit(2100), F.lit(1), F.col("id") + 1, F.lit(0), F.lit(0), F.lit(0))
    ends = spark.range(2).select((-1 - F.col("id")).alias("row_id"), ahead.alias("timestamp"), F.col("id").cast("string").alias("log_hash"))
    part = F.when(F.col("row_id") < 0, 2 - F.col("row_id")).otherwise(F.pmod(F.xxhash64("row_id"), F.lit(3)))
    stream = arriving(rows.unionByName(ends), "shuffled", part, 5)
    kept = drain(keep_first_stream(stream, ["log_hash"], "2 days"), "stream-first").where("row_id >= 0")
    return kept.select("row_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "log_hash")


@query(HEURISTIC)
def stream_restarted(spark, sf):
    """Five deliveries scored; the stream fails after the third was written, and goes on from its checkpoint."""
    stream = arriving(src.logs(spark, sf), "restarted", F.pmod("row_id", F.lit(5)), 5)
    scored = st.heuristic_scores(stream).select(
        "row_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly_detected"
    )
    base = scratch_dir(spark, "stream-restarted")
    paths = (f"{base}/scored", f"{base}/alerts", f"{base}/state")
    failed = st.write_scored_and_alerts(scored, *paths, available_now=True, fail_after=2)
    try:
        failed.awaitTermination()
    except StreamingQueryException:
        pass
    st.write_scored_and_alerts(scored, *paths, available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{base}/scored").select(*scored.columns)
    alerts = spark.read.parquet(f"{base}/alerts").select("row_id", F.lit(True).alias("alert"))
    checked = rows.join(alerts, "row_id", "left")
    return checked.where(F.coalesce("alert", F.lit(False)) == F.col("is_anomaly_detected")).drop("alert")
