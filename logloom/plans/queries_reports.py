"""Evaluation, monitoring and reporting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.models.scaling import minmax_probability, standardize
from logloom.operators import evaluate as ev
from logloom.operators import monitor as mo
from logloom.operators import report as rp
from logloom.operators.ordered import exact_percentiles
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.plans.queries_ingest import TS, shown


def rounded(df, *columns):
    columns = columns or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- scores ----------------------------------------------------------------------


@query(
    f"""WITH {src.LOGS} SELECT row_id, round(1 - (score - min(score) OVER ())
    / (max(score) OVER () - min(score) OVER ()), 6) AS anomaly_score FROM logs"""
)
def minmax_score(spark, sf):
    rows = minmax_probability(src.logs(spark, sf).select("row_id", "score"))
    return rounded(rows.select("row_id", "anomaly_score"))


@query(f"WITH {src.LOGS} SELECT row_id, 0.5 AS anomaly_score FROM logs".replace("0.5", "CAST(0.5 AS DOUBLE)"))
def minmax_constant(spark, sf):
    """Equal scores all become one half."""
    rows = src.logs(spark, sf).select("row_id", (F.col("score") * 0.0).alias("score"))
    return minmax_probability(rows).select("row_id", "anomaly_score")


@query(
    f"""WITH {src.LOGS} SELECT round(quantile_cont(score, 0.05), 6) AS threshold FROM logs"""
)
def score_threshold(spark, sf):
    rows = exact_percentiles(src.logs(spark, sf), "score", [0.05])
    return rows.select(F.round("percentile", 6).alias("threshold"))


@query(
    f"""WITH {src.LOGS} SELECT row_id,
    round((latency_ms - avg(latency_ms) OVER ()) / stddev_pop(latency_ms) OVER (), 6) AS latency_ms_z,
    round((score - avg(score) OVER ()) / stddev_pop(score) OVER (), 6) AS score_z FROM logs"""
)
def standardized(spark, sf):
    rows = standardize(src.logs(spark, sf), ["latency_ms", "score"])
    return rounded(rows.select("row_id", "latency_ms_z", "score_z"))


# --- evaluation ------------------------------------------------------------------

CONFUSION = """c AS (SELECT count(*) AS total_samples, count_if(y_true = 1) AS true_anomalies,
    count_if(y_pred = 1) AS predicted_anomalies, count_if(y_true = 0 AND y_pred = 0) AS true_negatives,
    count_if(y_true = 0 AND y_pred = 1) AS false_positives,
    count_if(y_true = 1 AND y_pred = 0) AS false_negatives,
    count_if(y_true = 1 AND y_pred = 1) AS true_positives FROM {source}
    WHERE y_true IS NOT NULL AND y_pred IS NOT NULL),
  m AS (SELECT CAST(COLUMNS(*) AS BIGINT), coalesce(true_positives / nullif(predicted_anomalies, 0), 0.0) AS p,
    coalesce(true_positives / nullif(true_anomalies, 0), 0.0) AS r FROM c)"""
CONFUSION_SELECT = """SELECT total_samples, true_anomalies, predicted_anomalies, true_negatives,
    false_positives, false_negatives, true_positives, round(p, 6) AS "precision", round(r, 6) AS recall,
    round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) AS f1_score FROM m"""


@query(
    f"""WITH {src.LABELLED}, b AS (SELECT y_true, CAST(CASE WHEN 1 - 2 * y_pred = -1 THEN 1 ELSE 0 END
    AS INTEGER) AS y_pred FROM labelled) SELECT y_true, y_pred, count(*) AS n FROM b GROUP BY 1, 2"""
)
def label_conventions(spark, sf):
    """Labels 0/1 beside predictions 1/-1."""
    rows = src.labelled(spark, sf).select("y_true", (1 - 2 * F.col("y_pred")).alias("label"))
    return (
        rows.select(
            ev.binary_label("y_true", "01").alias("y_true"),
            ev.binary_label("label", "pm1").alias("y_pred"),
        )
        .groupBy("y_true", "y_pred")
        .agg(F.count("*").alias("n"))
    )


@query(f"WITH {src.LABELLED}, {CONFUSION.format(source='labelled')} {CONFUSION_SELECT}")
def confusion_matrix(spark, sf):
    return rounded(ev.confusion(src.labelled(spark, sf)))


ALIGNED = """aligned AS (SELECT d.doc_id AS row_id, l.toxic AS y_true,
    CAST(d.n_chars > 2000 AS INTEGER) AS y_pred FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query(f"WITH {ALIGNED}, {CONFUSION.format(source='aligned')} {CONFUSION_SELECT}")
def label_alignment(spark, sf):
    """Labels of some documents joined to a rule's verdict on all of them."""
    labels = src.table(spark, sf, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("toxic").alias("y_true")
    )
    verdicts = src.table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), (F.col("n_chars") > 2000).cast("int").alias("y_pred")
    )
    return rounded(ev.confusion(ev.align(labels, verdicts)))


@query(
    f"""WITH {src.LABELLED}, {CONFUSION.format(source='labelled')},
    k AS (SELECT *, coalesce(true_negatives / nullif(true_negatives + false_negatives, 0), 0.0) AS p0,
      coalesce(true_negatives / nullif(true_negatives + false_positives, 0), 0.0) AS r0 FROM m),
    f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0.0) AS f0,
      coalesce(2 * p * r / nullif(p + r, 0), 0.0) AS f1, true_negatives + false_positives AS s0,
      true_positives + false_negatives AS s1, (true_positives + true_negatives) / total_samples AS a,
      total_samples AS n FROM k),
    rows AS (SELECT 'Normal' AS class, p0 AS p, r0 AS r, f0 AS f, s0 AS s FROM f
      UNION ALL SELECT 'Anomaly', p, r, f1, s1 FROM f UNION ALL SELECT 'accuracy', a, a, a, n FROM f
      UNION ALL SELECT 'macro avg', (p0 + p) / 2, (r0 + r) / 2, (f0 + f1) / 2, n FROM f
      UNION ALL SELECT 'weighted avg', (p0 * s0 + p * s1) / n, (r0 * s0 + r * s1) / n,
        (f0 * s0 + f1 * s1) / n, n FROM f)
    SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1_score,
      CAST(s AS BIGINT) AS support FROM rows"""
)
def class_report(spark, sf):
    return rounded(ev.class_report(src.labelled(spark, sf)))


@query(
    f"""WITH {src.LABELLED}, r AS (SELECT y_true, rank() OVER (ORDER BY score)
      + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM labelled),
    s AS (SELECT count_if(y_true = 1) AS p, count_if(y_true = 0) AS q,
      sum(rk) FILTER (y_true = 1) AS t FROM r)
    SELECT CAST(p AS BIGINT) AS positives, CAST(q AS BIGINT) AS negatives,
      round((t - p * (p + 1) / 2.0) / (p * q), 6) AS roc_auc FROM s"""
)
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(src.labelled(spark, sf)))


@query(
    f"""WITH {src.LOGS}, m AS (SELECT avg(score) AS mu, stddev_pop(score) AS sd FROM logs)
    SELECT count(score) AS total_samples, round(avg(score), 6) AS mean,
      round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min, round(max(score), 6) AS max,
      round(avg(((score - mu) / sd) ** 3), 6) AS skewness, round(kurtosis_pop(score), 6) AS kurtosis,
      round(quantile_cont(score, 0.5), 6) AS median, round(quantile_cont(score, 0.25), 6) AS q25,
      round(quantile_cont(score, 0.75), 6) AS q75,
      round(quantile_cont(score, 0.75) - quantile_cont(score, 0.25), 6) AS iqr FROM logs, m"""
)
def score_stats(spark, sf):
    return rounded(ev.score_statistics(src.logs(spark, sf)))


@query(
    f"""WITH {src.LOGS}, t AS (SELECT unnest([90.0, 95.0, 97.0, 99.0, 99.5]) AS percentile,
      unnest(quantile_cont(score, [0.9, 0.95, 0.97, 0.99, 0.995])) AS threshold FROM logs)
    SELECT CAST(percentile AS DOUBLE) AS percentile, round(threshold, 6) AS threshold,
      CAST(count_if(score >= threshold) AS BIGINT) AS anomalies_detected,
      round(count_if(score >= threshold) / count(*), 6) AS anomaly_rate
    FROM t, logs GROUP BY percentile, threshold"""
)
def threshold_table(spark, sf):
    rows = rounded(ev.threshold_table(src.logs(spark, sf)))
    return rows


@query(
    f"""WITH {src.LOGS}, e AS (SELECT min(score) AS a, max(score) AS b FROM logs),
    c AS (SELECT least(CAST(floor((score - a) / ((b - a) / 50)) AS INTEGER), 49) AS bin, count(*) AS n
      FROM logs, e GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(a + i * ((b - a) / 50), 6) AS low,
      round(a + (i + 1) * ((b - a) / 50), 6) AS high, coalesce(n, 0) AS n
    FROM e, range(0, 50) AS g(i) LEFT JOIN c ON c.bin = i"""
)
def score_histogram(spark, sf):
    return rounded(ev.histogram(src.logs(spark, sf)))


def _halves(spark, sf):
    logs = src.logs(spark, sf).select("timestamp", "score")
    day = F.lit("2024-01-16").cast("timestamp")
    return logs.where(F.col("timestamp") < day), logs.where(F.col("timestamp") >= day)


@query(
    f"""WITH {src.LOGS}, s AS (SELECT score AS v, "timestamp" >= TIMESTAMP '2024-01-16' AS cur FROM logs),
    t AS (SELECT count_if(NOT cur) AS n, count_if(cur) AS m, avg(v) FILTER (NOT cur) AS a,
      avg(v) FILTER (cur) AS b FROM s),
    g AS (SELECT v, sum(count_if(NOT cur)) OVER (ORDER BY v) AS cn,
      sum(count_if(cur)) OVER (ORDER BY v) AS cm FROM s GROUP BY v)
    SELECT CAST(n AS BIGINT) AS reference_n, CAST(m AS BIGINT) AS current_n,
      round(max(abs(cn / n - cm / m)), 6) AS statistic, round(a, 6) AS reference_mean,
      round(b, 6) AS current_mean, round(b - a, 6) AS mean_shift FROM g, t GROUP BY n, m, a, b"""
)
def ks_drift(spark, sf):
    rows = rounded(ev.ks_drift(*_halves(spark, sf)))
    return rows.drop("p_value", "drift_detected")


@query()
def ks_drift_decision(spark, sf):
    """The p-value and verdict of the same test."""
    return ev.ks_drift(*_halves(spark, sf)).select("p_value", "drift_detected")


KS_ROWS = 1000


@query(
    f"""WITH {src.LOGS}, r AS (SELECT score FROM logs ORDER BY "timestamp", row_id LIMIT {KS_ROWS}),
    c AS (SELECT score FROM logs ORDER BY "timestamp" DESC, row_id DESC LIMIT {KS_ROWS}),
    v AS (SELECT score, sum(x) AS n, sum(y) AS m FROM
      (SELECT score, 1 AS x, 0 AS y FROM r UNION ALL SELECT score, 0, 1 FROM c) GROUP BY score),
    g AS (SELECT max(abs(d)) AS h FROM (SELECT sum(n - m) OVER (ORDER BY score) AS d FROM v)),
    k AS (SELECT h, unnest(range(1, {KS_ROWS} // CAST(h AS BIGINT) + 1)) AS k FROM g)
    SELECT CAST({KS_ROWS} AS BIGINT) AS reference_n, CAST({KS_ROWS} AS BIGINT) AS current_n, round(max(h) / {KS_ROWS}, 6) AS statistic,
      round(least(1.0, 2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END
        * exp(2 * lgamma({KS_ROWS} + 1) - lgamma({KS_ROWS} - k * h + 1) - lgamma({KS_ROWS} + k * h + 1)))), 6) AS p_value
    FROM k"""
)
def ks_exact(spark, sf):
    """The exact p-value of two windows of equal size, for which it has a closed form."""
    logs = src.logs(spark, sf)
    oldest = logs.orderBy("timestamp", "row_id").limit(KS_ROWS)
    newest = logs.orderBy(F.desc("timestamp"), F.desc("row_id")).limit(KS_ROWS)
    return rounded(ev.ks_drift(oldest, newest)).select("reference_n", "current_n", "statistic", "p_value")


@query(
    f"""WITH {src.LOGS}, e AS (SELECT service AS model_name, CAST(substring(service, 5) AS INTEGER) AS pos,
      count_if(is_anomaly = 1 AND level = 'CRITICAL') AS tp, count_if(level = 'CRITICAL') AS p,
      count_if(is_anomaly = 1) AS t FROM logs GROUP BY 1, 2),
    f AS (SELECT *, CASE WHEN p + t > 0 THEN 2.0 * tp / (p + t) ELSE 0 END AS f1 FROM e)
    SELECT model_name AS best_model, round(f1, 6) AS best_f1 FROM f ORDER BY f1 DESC, pos LIMIT 1"""
)
def compare_models(spark, sf):
    """One rule evaluated per service, as if each were a model."""
    f1 = F.try_divide(2.0 * F.col("tp"), F.col("p") + F.col("t"))
    rows = (
        src.logs(spark, sf)
        .groupBy("service")
        .agg(
            F.count_if((F.col("is_anomaly") == 1) & (F.col("level") == "CRITICAL")).alias("tp"),
            F.count_if(F.col("level") == "CRITICAL").alias("p"),
            F.count_if(F.col("is_anomaly") == 1).alias("t"),
        )
        .select(
            F.col("service").alias("model_name"),
            F.substring("service", 5, 9).cast("int").alias("position"),
            F.coalesce(f1, F.lit(0.0)).alias("f1_score"),
        )
    )
    return rounded(ev.compare_models(rows))


# --- monitoring ------------------------------------------------------------------

RECENT = """recent AS (SELECT *, is_anomaly = 1 AS hit FROM logs ORDER BY "timestamp" DESC, row_id DESC LIMIT 10000)"""
METRICS = """metrics AS (SELECT (SELECT count(*) FROM logs) AS total_predictions,
    (SELECT count_if(is_anomaly = 1) FROM logs) AS total_anomalies, count(*) AS window_size,
    count_if(hit) AS window_anomalies, count_if(hit) / count(*) AS window_rate,
    (SELECT count(*) FROM logs WHERE level = 'CRITICAL') AS total_errors FROM recent),
  latency AS (SELECT avg(latency_ms) AS mean, quantile_cont(latency_ms, 0.5) AS p50,
    quantile_cont(latency_ms, 0.9) AS p90, quantile_cont(latency_ms, 0.95) AS p95,
    quantile_cont(latency_ms, 0.99) AS p99, max(latency_ms) AS max FROM recent)"""
WINDOW = 10000


def _metrics(spark, sf):
    return mo.rolling_metrics(src.predictions(spark, sf), src.failures(spark, sf), WINDOW)


def _latency(spark, sf):
    return mo.latency_statistics(src.predictions(spark, sf), WINDOW)


@query(
    f"""WITH {src.LOGS}, {RECENT}, {METRICS} SELECT total_predictions,
    CAST(total_anomalies AS BIGINT) AS total_anomalies, window_size,
    CAST(window_anomalies AS BIGINT) AS window_anomalies, round(window_rate, 6) AS window_rate,
    round(total_anomalies / total_predictions, 6) AS overall_rate, total_errors,
    round(total_errors / (total_predictions + total_errors), 6) AS error_rate FROM metrics"""
)
def rolling_metrics(spark, sf):
    return rounded(_metrics(spark, sf))


@query(f"WITH {src.LOGS}, {RECENT} SELECT row_id FROM recent")
def newest_rows(spark, sf):
    return mo.last_rows(src.predictions(spark, sf), WINDOW).select("row_id")


@query(
    f"""WITH {src.LOGS}, {RECENT}, {METRICS} SELECT round(mean, 6) AS mean, round(p50, 6) AS p50,
    round(p90, 6) AS p90, round(p95, 6) AS p95, round(p99, 6) AS p99, round(max, 6) AS max FROM latency"""
)
def latency_stats(spark, sf):
    return rounded(_latency(spark, sf))


@query(
    f"""WITH {src.LOGS}, {RECENT}, {METRICS} SELECT 'P50' AS percentile, round(p50, 6) AS latency_ms
    FROM latency UNION ALL SELECT 'P90', round(p90, 6) FROM latency
    UNION ALL SELECT 'P95', round(p95, 6) FROM latency UNION ALL SELECT 'P99', round(p99, 6) FROM latency"""
)
def latency_view(spark, sf):
    return rounded(rp.latency_rows(_latency(spark, sf)))


@query(
    f"""WITH {src.LOGS}, {RECENT} SELECT round(avg(score), 6) AS mean,
    round(stddev_pop(score), 6) AS std, round(min(score), 6) AS min, round(max(score), 6) AS max FROM recent"""
)
def score_window_stats(spark, sf):
    return rounded(mo.score_summary(src.predictions(spark, sf), WINDOW))


@query(
    f"""WITH {src.LOGS}, {RECENT} SELECT count(*) AS requests, round(count(*) / 86400.0, 6)
    AS rate_per_second FROM recent WHERE epoch_us((SELECT max("timestamp") FROM logs))
    - epoch_us("timestamp") < 86400000000"""
)
def request_rate(spark, sf):
    """Rate over the last day before the newest row."""
    return rounded(mo.request_rate(src.predictions(spark, sf), seconds=86400, window=WINDOW))


@query(
    f"""WITH {src.LOGS}, {RECENT}, {METRICS}, v AS (SELECT window_rate AS r, p99,
      total_errors / (total_predictions + total_errors) AS e FROM metrics, latency)
    SELECT 'CRITICAL' AS severity, 'anomaly_rate' AS type, round(r, 6) AS value FROM v WHERE r > 0.06
    UNION ALL SELECT 'WARNING', 'anomaly_rate', round(r, 6) FROM v WHERE r > 0.02 AND r <= 0.06
    UNION ALL SELECT 'WARNING', 'latency', round(p99, 6) FROM v WHERE p99 > 200
    UNION ALL SELECT 'CRITICAL', 'error_rate', round(e, 6) FROM v WHERE e > 0.01"""
)
def alert_rules(spark, sf):
    limits = {
        "anomaly_rate_warning": 0.02,
        "anomaly_rate_critical": 0.06,
        "latency_p99_ms": 200.0,
        "error_rate": 0.01,
    }
    alerts = mo.check_alerts(_metrics(spark, sf), _latency(spark, sf), limits)
    return rounded(alerts.drop("message"))


@query(
    f"""WITH {src.LOGS}, {RECENT}, s AS (SELECT score AS v, false AS cur FROM logs
      WHERE "timestamp" < TIMESTAMP '2024-01-10' UNION ALL SELECT score, true FROM recent),
    t AS (SELECT count_if(NOT cur) AS n, count_if(cur) AS m FROM s),
    g AS (SELECT v, sum(count_if(NOT cur)) OVER (ORDER BY v) AS cn,
      sum(count_if(cur)) OVER (ORDER BY v) AS cm FROM s GROUP BY v)
    SELECT CAST(n AS BIGINT) AS reference_n, CAST(m AS BIGINT) AS current_n,
      round(max(abs(cn / n - cm / m)), 6) AS statistic FROM g, t GROUP BY n, m"""
)
def drift_check(spark, sf):
    predictions = src.predictions(spark, sf)
    reference = predictions.where(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp"))
    rows = mo.drift_check(predictions, reference, window=WINDOW)
    return rounded(rows.select("reference_n", "current_n", "statistic"))


@query(
    f"""WITH {src.LOGS}, {RECENT}, {METRICS} SELECT name, type, round(CAST(value AS DOUBLE), 6) AS value FROM (
    SELECT 'logloom_predictions_total' AS name, 'counter' AS type, total_predictions AS value FROM metrics
    UNION ALL SELECT 'logloom_anomalies_total', 'counter', total_anomalies FROM metrics
    UNION ALL SELECT 'logloom_anomaly_rate', 'gauge', window_rate FROM metrics
    UNION ALL SELECT 'logloom_latency_avg_ms', 'gauge', mean FROM latency
    UNION ALL SELECT 'logloom_latency_p99_ms', 'gauge', p99 FROM latency
    UNION ALL SELECT 'logloom_errors_total', 'counter', total_errors FROM metrics)"""
)
def metric_lines(spark, sf):
    rows = mo.metric_lines(_metrics(spark, sf), _latency(spark, sf))
    return rounded(rows.select("name", "type", "value"))


# --- reports ---------------------------------------------------------------------


@query(
    f"""WITH {src.LOGS} SELECT count(*) AS total_logs, CAST(count_if(is_anomaly = 1) AS BIGINT) AS anomalies,
    count(DISTINCT service) AS services, CAST(count_if(level IN ('ERROR', 'CRITICAL')) AS BIGINT) AS errors,
    round(count_if(is_anomaly = 1) / count(*), 6) AS anomaly_rate FROM logs"""
)
def kpis(spark, sf):
    return rounded(rp.kpis(src.logs(spark, sf)))


SPINE = """h AS (SELECT date_trunc('hour', "timestamp") AS hour, is_anomaly FROM logs),
  spine AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h)"""


@query(
    f"""WITH {src.LOGS}, {SPINE} SELECT {TS.format('spine.hour')} AS hour, count(h.hour) AS n
    FROM spine LEFT JOIN h ON spine.hour = h.hour GROUP BY 1"""
)
def hourly_volume(spark, sf):
    return rp.hourly_volume(src.logs(spark, sf)).select(shown("hour"), "n")


@query(
    f"""WITH {src.LOGS}, {SPINE} SELECT {TS.format('spine.hour')} AS hour,
    count(*) FILTER (is_anomaly = 0) AS normal_count, count(*) FILTER (is_anomaly = 1) AS anomaly_count
    FROM spine LEFT JOIN h ON spine.hour = h.hour GROUP BY 1"""
)
def hourly_split(spark, sf):
    rows = rp.hourly_split(src.logs(spark, sf))
    return rows.select(shown("hour"), "normal_count", "anomaly_count")


@query(f"WITH {src.LOGS} SELECT level, count(*) AS n FROM logs GROUP BY 1")
def level_distribution(spark, sf):
    return rp.level_distribution(src.logs(spark, sf))


@query(
    f"""WITH {src.LOGS} SELECT {TS.format('"timestamp"')} AS "timestamp", level, service, message FROM (
    SELECT * FROM logs WHERE is_anomaly = 1 ORDER BY "timestamp" DESC, row_id DESC LIMIT 10)"""
)
def recent_anomalies(spark, sf):
    rows = rp.recent_anomalies(src.logs(spark, sf))
    return rows.withColumn("timestamp", shown("timestamp"))


@query(
    f"""WITH {src.LOGS} SELECT service, count(*) AS n FROM logs WHERE is_anomaly = 1 GROUP BY 1
    ORDER BY n DESC, service LIMIT 10"""
)
def top_services(spark, sf):
    return rp.top_services(src.logs(spark, sf))


@query(f"WITH {src.LOGS} SELECT level, count(*) AS n FROM logs WHERE is_anomaly = 1 GROUP BY 1")
def anomalies_by_level(spark, sf):
    return rp.anomalies_by_level(src.logs(spark, sf))


@query(
    f"""WITH {src.LOGS} SELECT message, count(*) AS n, substring(message, 1, 120) AS shown FROM logs
    WHERE is_anomaly = 1 GROUP BY 1 ORDER BY n DESC, message LIMIT 15"""
)
def top_messages(spark, sf):
    return rp.top_messages(src.logs(spark, sf))


@query(
    f"""WITH {src.LOGS}, s AS (SELECT service, count(*) AS total,
      CAST(count_if(is_anomaly = 1) AS BIGINT) AS anomalies FROM logs GROUP BY 1)
    SELECT service, total, anomalies, round(anomalies / total, 6) AS rate,
      CASE WHEN anomalies / total < 0.05 THEN 'green' WHEN anomalies / total < 0.15 THEN 'yellow'
      ELSE 'red' END AS health FROM s"""
)
def service_health(spark, sf):
    return rounded(rp.service_health(src.logs(spark, sf)))


@query(
    f"""WITH {src.LOGS} SELECT service, count(is_anomaly) AS total,
    CAST(sum(is_anomaly) AS BIGINT) AS anomalies,
    round(sum(is_anomaly) / count(is_anomaly), 6) AS anomaly_rate FROM logs GROUP BY 1"""
)
def service_anomaly_rate(spark, sf):
    return rounded(rp.service_anomaly_rate(src.logs(spark, sf)))


@query(f"WITH {src.LOGS} SELECT DISTINCT service FROM logs")
def service_list(spark, sf):
    return rp.services(src.logs(spark, sf))


@query(
    f"""WITH {src.LABELLED} SELECT CASE y_true WHEN 1 THEN 'Anomaly' ELSE 'Normal' END AS actual,
    CASE y_pred WHEN 1 THEN 'Anomaly' ELSE 'Normal' END AS predicted, count(*) AS n
    FROM labelled GROUP BY 1, 2
    UNION ALL SELECT 'Anomaly', 'Normal', 0 WHERE NOT EXISTS
      (SELECT 1 FROM labelled WHERE y_true = 1 AND y_pred = 0)"""
)
def confusion_view(spark, sf):
    return rp.confusion_cells(ev.confusion(src.labelled(spark, sf)))
