"""Train, score, save and load detectors by name."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.scores import confidence, is_anomaly
from logloom.models import iforest, ocsvm
from logloom.models.autoencoder import Autoencoder
from logloom.models.iforest import IsolationForest
from logloom.models.ocsvm import OneClassSVM
from logloom.models.scaling import minmax_probability
from logloom.session import materialize
from logloom.sources.versions import VersionedTables

MODELS = {
    "isolation_forest": IsolationForest,
    "one_class_svm": OneClassSVM,
    "autoencoder": Autoencoder,
}
TUNERS = {"isolation_forest": iforest.tune, "one_class_svm": ocsvm.tune}
TUNED = {
    "isolation_forest": {"n_estimators", "max_samples"},
    "one_class_svm": {"kernel", "nu", "gamma"},
}

# Settings a training run uses unless told otherwise.
CONFIGURED = {
    "isolation_forest": {"n_estimators": 200, "contamination": 0.05, "max_samples": "auto"},
    "one_class_svm": {"nu": 0.05, "gamma": "scale"},
    "autoencoder": {},
}

MODEL_META = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("training_samples", T.LongType()),
        T.StructField("feature_count", T.LongType()),
        T.StructField("params", T.StringType()),
        T.StructField("tuning", T.StringType()),
        T.StructField("trained_at", T.TimestampType()),
        T.StructField("state", T.StringType()),
    ]
)


class Detector:
    """A trained model with its metadata."""

    def __init__(self, name: str, model, version: str, trained_at: datetime) -> None:
        self.name = name
        self.model = model
        self.version = version
        self.trained_at = trained_at

    def score(self, df: DataFrame, bounds: str = "batch") -> DataFrame:
        """Replaces ``features`` by score, label, 0..1 score, confidence and flag.

        ``bounds="batch"`` scales by the range of the rows given;
        ``bounds="fitted"`` by the training range, which a stream needs.
        """
        fitted = (self.model.score_min, self.model.score_max)
        if bounds == "fitted" and None in fitted:
            raise ValueError("the model was fitted without a score range")
        if bounds == "fitted":
            return self._scaled(self.model.score(df), fitted)
        # The range is taken from the scores: they are written first, so that the model runs once.
        return self._scaled(materialize(self.model.score(df), "scores"), None)

    def training_scores(self) -> DataFrame:
        """What ``score`` gives for the training rows, from the scores that calibration left."""
        return self._scaled(self.model.training_scores(), (self.model.score_min, self.model.score_max))

    @staticmethod
    def _scaled(scored: DataFrame, bounds: tuple | None) -> DataFrame:
        return minmax_probability(scored, bounds=bounds).withColumns(
            {
                "is_anomaly_detected": is_anomaly("anomaly_label"),
                "confidence": confidence("anomaly_score"),
            }
        )

    def metadata(self) -> dict:
        return {
            "model_name": self.name,
            "version": self.version,
            "training_samples": self.model.n_rows,
            "feature_count": self.model.size,
            "params": self.model.params,
            "trained_at": self.trained_at,
        }

    def save(self, spark: SparkSession, base: str, version: str | None = None) -> str:
        """Write the model as one version under its name; returns the version."""
        body = {
            "training_samples": int(self.model.n_rows),
            "feature_count": int(self.model.size),
            "params": json.dumps(self.model.params, default=str),
            "tuning": json.dumps(getattr(self.model, "tuning", None) or [], default=str),
            "trained_at": self.trained_at.isoformat(),
            "state": json.dumps(self.model.meta()),
        }
        return VersionedTables(spark, base).save(self.name, self.model.tables(spark), body, version or self.version)

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        base: str,
        version: str = "latest",
        name: str | None = None,
    ) -> "Detector":
        meta = model_versions(spark, base)
        if name is not None:
            meta = meta.where(F.col("model_name") == name)
        if version != "latest":
            meta = meta.where(F.col("version") == version)
        rows = meta.orderBy(F.desc("version"), F.desc("trained_at")).limit(1).collect()
        if not rows:
            raise FileNotFoundError(f"no model {name or ''} {version} under {base}")
        row = rows[0]
        tables, body, _ = VersionedTables(spark, base).load(row["model_name"], row["version"])
        model = MODELS[row["model_name"]].from_tables(tables, json.loads(body["state"]))
        return cls(row["model_name"], model, row["version"], row["trained_at"])


def train(
    df: DataFrame, name: str = "isolation_forest", tune: bool = False, **params
) -> Detector:
    """Fit the named model on ``(row_id, features)``."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; available: {sorted(MODELS)}")
    settings = {**CONFIGURED[name], **params}
    if tune and name in TUNERS:
        # A tuned setting is searched over a tuple; its single configured value is dropped.
        grid = {
            k: v for k, v in settings.items() if k not in TUNED[name] or isinstance(v, tuple)
        }
        model = TUNERS[name](df, **grid)
    else:
        model = MODELS[name].fit(df, **settings)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return Detector(name, model, now.strftime("v%Y%m%d_%H%M%S_%f"), now)


def model_versions(spark: SparkSession, base: str) -> DataFrame:
    """Committed models, a row per version."""
    wanted = [f for f in MODEL_META.fields if f.name not in ("model_name", "version")]
    figures = F.from_json("body", T.StructType(wanted))
    rows = VersionedTables(spark, base).versions()
    return rows.select(F.col("group_name").alias("model_name"), "version", F.inline(F.array(figures)))


def batch_summary(scored: DataFrame, flag: str = "is_anomaly_detected") -> DataFrame:
    """One row: rows, anomalies, rate."""
    return scored.agg(
        F.count("*").alias("total_logs"),
        F.count_if(F.col(flag)).alias("total_anomalies"),
    ).withColumn(
        "anomaly_rate",
        F.col("total_anomalies") / F.greatest(F.col("total_logs"), F.lit(1)),
    )
