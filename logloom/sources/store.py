"""Versioned Parquet tables: features, models, reports, runs, dead letters."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_META = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_features", T.LongType()),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("extra", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_name", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("training_samples", T.LongType()),
        T.StructField("feature_count", T.LongType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("logged_at", T.TimestampType()),
    ]
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a table folder that this library wrote; nothing happens if it is gone."""
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)


def write_text(spark: SparkSession, path: str, body: str, overwrite: bool = True) -> None:
    """A small file in the table's own file system.  Without ``overwrite`` an existing file is an error."""
    fs, hadoop = _file_system(spark, path)
    out = fs.create(hadoop, overwrite)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()


def write_quarantine(rows: DataFrame, path: str, ingest_date: str | None = None) -> None:
    """Append dead letters with their reasons, one folder per ingest date."""
    day = ingest_date or _now().strftime("%Y-%m-%d")
    rows.withColumn("ingest_date", F.lit(day)).write.mode("append").partitionBy(
        "ingest_date"
    ).parquet(path)


def write_clean(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write cleaned rows by event date, so that date filters prune folders."""
    rows.withColumn("event_date", F.to_date("timestamp")).write.mode(mode).partitionBy(
        "event_date"
    ).parquet(path)


class FeatureStore:
    """Feature tables by dataset and version; a save is visible as a whole or not at all."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        from logloom.sources.versions import VersionedTables

        self.spark = spark
        self.tables = VersionedTables(spark, base)

    def save(
        self,
        features: DataFrame,
        feature_names: list[str],
        dataset: str = "training",
        version: str | None = None,
        extra: dict | None = None,
    ) -> str:
        def figures(paths: dict) -> dict:
            n_rows = self.spark.read.parquet(paths["features"]).count()
            names = list(feature_names)
            return {"n_rows": n_rows, "n_features": len(names), "feature_names": names, "extra": json.dumps(extra or {}, default=str)}

        return self.tables.save(dataset, {"features": features}, figures, version)

    def load(self, dataset: str = "training", version: str | None = None):
        """(features, names); the newest version is the lexicographic maximum."""
        tables, figures, _ = self.tables.load(dataset, version)
        return tables["features"], list(figures["feature_names"])

    def metadata(self) -> DataFrame:
        figures = F.from_json("body", "n_rows bigint, n_features bigint, feature_names array<string>, extra string")
        return self.tables.versions().select(
            F.col("group_name").alias("dataset"), "version", F.inline(F.array(figures)), "created_at"
        ).select(*FEATURE_META.names)

    def versions(self, dataset: str | None = None) -> DataFrame:
        return list_versions(self.metadata(), dataset)


def list_versions(meta: DataFrame, dataset: str | None = None) -> DataFrame:
    """Stored versions, newest first."""
    if dataset is not None:
        meta = meta.where(F.col("dataset") == dataset)
    return meta.orderBy(F.desc("created_at"), F.desc("version"))


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def save_report(metrics: DataFrame, path: str, name: str, version: str | None = None) -> str:
    """Append metric rows under a report name and version."""
    version = version or _now().strftime("%Y%m%d_%H%M%S")
    append_rows(
        metrics.select(F.lit(name).alias("report"), F.lit(version).alias("version"), "*"), path
    )
    return version


def record_run(
    spark: SparkSession,
    path: str,
    model_name: str,
    version: str,
    training_samples: int,
    feature_count: int,
    params: dict,
    metrics: dict,
) -> None:
    row = (
        f"{model_name}_{version}",
        model_name,
        version,
        int(training_samples),
        int(feature_count),
        {k: str(v) for k, v in params.items()},
        {k: None if v is None else float(v) for k, v in metrics.items()},
        _now(),
    )
    append_rows(spark.createDataFrame([row], RUN_SCHEMA).coalesce(1), path)
