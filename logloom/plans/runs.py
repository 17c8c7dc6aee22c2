"""Training and scoring runs from raw lines to scored rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.parsing import parse_lines
from logloom.models.registry import Detector, batch_summary, train
from logloom.operators.assemble import FeatureModel
from logloom.operators.clean import preprocess
from logloom.operators.evaluate import binary_label, evaluate_labeled, evaluate_unlabeled
from logloom.operators.features import with_template
from logloom.operators.report import service_health
from logloom.operators.tfidf import with_words
from logloom.operators.validate import validate
from logloom.schema import ROW_ID
from logloom.session import materialize
from logloom.sources.store import record_run


@dataclass
class TrainingRun:
    """What a training run leaves behind."""

    clean: DataFrame
    quarantined: DataFrame
    report: DataFrame
    features: FeatureModel
    detector: Detector
    scored: DataFrame
    clean_options: dict = field(default_factory=dict)


def clean_logs(parsed: DataFrame, dedup: bool = True, **options):
    """(clean rows, validation result) of parsed log rows."""
    limits = {k: options[k] for k in ("default_year",) if k in options}
    checked = validate(parsed, **limits)
    return preprocess(checked.valid, dedup=dedup, **options), checked


def train_run(
    parsed: DataFrame,
    model: str = "isolation_forest",
    tune: bool = False,
    dedup: bool = True,
    max_features: int = 5000,
    clean_options: dict | None = None,
    **params,
) -> TrainingRun:
    """Validate, clean, build features, fit and score.

    Parsed rows, cleaned rows with their templates and words, and features are written once each: every later
    step reads those tables instead of parsing the lines again.
    """
    clean, checked = clean_logs(materialize(parsed, "parsed"), dedup, **(clean_options or {}))
    names = clean.columns
    templated = materialize(with_words(with_template(clean)), "clean")
    clean = templated.select(*names)
    features = FeatureModel.fit(templated, max_features=max_features)
    # The counts of this very table were just fitted: taking them from the saved
    # tables gives the batch-relative figures without counting again.
    rows = materialize(features.transform(templated, stats="training"), "feature-rows")
    detector = train(rows, model, tune=tune, size=len(features.names), **params)
    scored = clean.join(detector.training_scores(), ROW_ID)
    return TrainingRun(clean, checked.quarantined, checked.report, features, detector, scored, clean_options or {})


def score_batch(
    parsed: DataFrame,
    features: FeatureModel,
    detector: Detector,
    stats: str = "batch",
    bounds: str = "batch",
    dedup: bool = False,
    clean_options: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(scored rows, one summary row) of new log rows, cleaned with the options of the training run."""
    clean = materialize(preprocess(parsed, dedup=dedup, **(clean_options or {})), "clean")
    scored = clean.join(detector.score(features.transform(clean, stats), bounds), ROW_ID)
    return scored, batch_summary(scored)


def evaluate_run(run: TrainingRun) -> dict[str, DataFrame]:
    """Reports of a run: by labels where rows have one, and by scores alone.

    Scores and labels are read from one written copy of four narrow columns.
    """
    rows = run.scored.select(
        ROW_ID,
        binary_label("is_anomaly", "01").alias("y_true"),
        binary_label("anomaly_label", "pm1").alias("y_pred"),
        F.col("anomaly_score").alias("score"),
    )
    rows = materialize(rows, "evaluation")
    return {**evaluate_labeled(rows), **evaluate_unlabeled(rows)}


def track_run(run: TrainingRun, reports: dict[str, DataFrame], path: str) -> None:
    """Append the run with its settings and headline figures to the run table."""
    meta = run.detector.metadata()
    c, auc = reports["confusion"].first(), reports["roc_auc"].first()
    record_run(
        run.clean.sparkSession,
        path,
        meta["model_name"],
        meta["version"],
        meta["training_samples"],
        meta["feature_count"],
        meta["params"],
        {
            "precision": c["precision"],
            "recall": c["recall"],
            "f1_score": c["f1_score"],
            "roc_auc": auc["roc_auc"],
        },
    )


def service_health_of_lines(lines: DataFrame, **params) -> DataFrame:
    """Which services are unhealthy, by detected anomalies, from raw text lines."""
    run = train_run(parse_lines(lines, "line"), **params)
    flagged = run.scored.withColumn("is_anomaly", F.col("is_anomaly_detected").cast("int"))
    return service_health(flagged)
