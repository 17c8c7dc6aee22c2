"""Detector queries: fitting and scoring on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions.parsing import parse_lines
from logloom.models import iforest, ocsvm
from logloom.models.registry import batch_summary, train
from logloom.operators.report import service_health
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.plans.runs import score_batch as score_batch_run
from logloom.plans.runs import service_health_of_lines, train_run
from logloom.session import materialize

# Scores depend on random draws, so these queries have no SQL twin; the tests
# check their invariants.


@query()
def unhealthy_services(spark, sf):
    """From raw lines to service health by detected anomalies."""
    return service_health_of_lines(
        src.raw_lines(spark, sf),
        clean_options={"default_year": 2024},
    )


@query()
def iforest_scores(spark, sf):
    rows = src.vectors(spark, sf)
    return train(rows, "isolation_forest").score(rows)


@query()
def iforest_tuning(spark, sf):
    """Separation of the scores of every setting of the grid."""
    rows = src.vectors(spark, sf)
    return iforest.tuning_table(spark, iforest.tune(rows))


@query(
    """SELECT CAST(t AS INTEGER) AS n_estimators, m AS max_samples, TRUE AS separated,
    CAST(greatest(ceil(0.05 * ((SELECT count(*) FROM embeddings) - 1)), 1) AS BIGINT) AS n_low
    FROM (VALUES (20), (40)) a(t), (VALUES ('0.5'), ('1.0')) b(m)"""
)
def iforest_tuning_grid(spark, sf):
    """A smaller grid: its settings, whether the lowest twentieth stands apart, and how many rows that is."""
    rows = src.vectors(spark, sf)
    n = rows.count()
    tried = iforest.tuning_table(spark, iforest.tune(rows, n_estimators=(20, 40), max_samples=(0.5, 1.0)))
    return tried.select(
        "n_estimators",
        "max_samples",
        (F.col("separation_score") > 0).alias("separated"),
        F.round(F.col("anomaly_ratio") * n).cast("bigint").alias("n_low"),
    )


@query()
def ocsvm_scores(spark, sf):
    rows = src.vectors(spark, sf)
    return train(rows, "one_class_svm").score(rows)


@query()
def ocsvm_tuning(spark, sf):
    """Spread of the scores of every setting of the grid: two kernels, three nu, two gamma."""
    return ocsvm.tuning_table(spark, ocsvm.tune(src.vectors(spark, sf)))


@query()
def autoencoder_scores(spark, sf):
    rows = src.vectors(spark, sf)
    return train(rows, "autoencoder").score(rows)


@query(
    """WITH n AS (SELECT count(*) AS n FROM embeddings)
    SELECT m AS model_name, n AS n_rows, CAST(CASE WHEN m = 'autoencoder' THEN n - 1 - floor(0.95 * (n - 1)) ELSE ceil(0.05 * (n - 1)) END AS BIGINT)
      AS n_flagged, 0.0::DOUBLE AS lowest, 1.0::DOUBLE AS highest, TRUE AS kept_scores
    FROM n, (VALUES ('isolation_forest'), ('one_class_svm'), ('autoencoder')) t(m)"""
)
def detector_shares(spark, sf):
    """Short trainings of all detectors: the share they flag, the range of the 0..1 score, and the scores kept from calibration."""
    rows = src.vectors(spark, sf)
    short = {"isolation_forest": {"n_estimators": 50}, "one_class_svm": {"iterations": 5}, "autoencoder": {"epochs": 2}}
    parts = []
    for name, settings in short.items():
        detector = train(rows, name, **settings)
        kept = detector.training_scores().select("row_id", F.col("score").alias("kept"))
        parts.append(
            detector.score(rows)
            .join(kept, "row_id")
            .agg(
                F.count("*").alias("n_rows"),
                F.count_if("is_anomaly_detected").alias("n_flagged"),
                F.round(F.min("anomaly_score"), 6).alias("lowest"),
                F.round(F.max("anomaly_score"), 6).alias("highest"),
                F.every(F.abs(F.col("score") - F.col("kept")) < 1e-9).alias("kept_scores"),
            )
            .select(F.lit(name).alias("model_name"), "*")
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query()
def score_batch(spark, sf):
    """Train on the first half of the time range, score the second half as new rows.

    The halves are parted before their lines are made, so each line is parsed once.  A table in the order of
    time has either half in few of its splits: their rows are dealt out again.
    """
    logs, halfway = src.logs(spark, sf), F.lit("2024-01-16").cast("timestamp")

    def parsed(half):
        return parse_lines(src.raw_lines_of(logs.where(half).repartition("row_id")))

    run = train_run(parsed(F.col("timestamp") < halfway), clean_options={"default_year": 2024})
    # Written before they are cleaned: one stage that matches and cleans lines takes longer than two.
    new = materialize(parsed(F.col("timestamp") >= halfway), "parsed")
    scored, _ = score_batch_run(
        new, run.features, run.detector, stats="fitted", bounds="fitted",
        clean_options=run.clean_options,
    )
    return scored.select(
        "row_id", "service", "score", "anomaly_label", "anomaly_score", "confidence",
        "is_anomaly_detected",
    )


@query(
    f"""WITH {src.LOGS} SELECT count(*) AS total_logs,
    CAST(count_if(score > 0.4) AS BIGINT) AS total_anomalies,
    round(count_if(score > 0.4) / count(*), 6) AS anomaly_rate FROM logs"""
)
def scored_summary(spark, sf):
    """Summary of rows flagged by a score limit."""
    rows = src.logs(spark, sf).withColumn("is_anomaly_detected", F.col("score") > 0.4)
    return batch_summary(rows).withColumn("anomaly_rate", F.round("anomaly_rate", 6))


@query()
def health_by_model(spark, sf):
    """Service health from an isolation forest on the numeric log columns."""
    logs = src.logs(spark, sf, heavy=True)
    rows = logs.select(
        "row_id",
        F.array(
            F.col("latency_ms"),
            F.length("message").cast("double"),
            F.hour("timestamp").cast("double"),
        ).alias("features"),
    )
    detector = train(rows, "isolation_forest")
    flagged = logs.drop("score", "is_anomaly").join(
        detector.training_scores().select(
            "row_id", F.col("is_anomaly_detected").cast("int").alias("is_anomaly")
        ),
        "row_id",
    )
    return service_health(flagged)
