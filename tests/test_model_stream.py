"""Scoring a stream with the fitted feature model: equal to batch scoring, also after a failure."""

import pytest
from pyspark.sql import functions as F

from logloom.models.registry import train
from logloom.operators.assemble import FeatureModel
from logloom.streaming import model_stream as ms
from logloom.streaming import streams as st

SCHEMA = "row_id bigint, timestamp timestamp, level string, service string, source_ip string, message string, anomaly_score double"


def logs(spark, first, minutes, every=3):
    """Rows every ``every`` minutes; the columns hold one that scoring adds as well."""
    return spark.range(first, first + minutes // every).select(
        F.col("id").alias("row_id"),
        (F.lit("2024-01-15 00:00:00").cast("timestamp") + F.make_dt_interval(mins=(F.col("id") - first) * every)).alias("timestamp"),
        F.element_at(F.array(*map(F.lit, ("INFO", "ERROR", "WARNING"))), (F.col("id") % 3 + 1).cast("int")).alias("level"),
        F.concat(F.lit("svc-"), (F.col("id") % 4).cast("string")).alias("service"),
        F.lit("10.0.0.1").alias("source_ip"),
        F.concat(F.lit("took "), (F.col("id") % 50).cast("string"), F.lit("ms")).alias("message"),
        F.lit(-1.0).alias("anomaly_score"),
    )


@pytest.fixture(scope="module")
def fitted(spark):
    rows = logs(spark, 0, 600)
    features = FeatureModel.fit(rows, max_features=10)
    return features, train(features.transform(rows, stats="training"), size=len(features.names), n_estimators=10)


def deliver(rows, path, parts):
    for part in parts:
        rows.where(part).coalesce(1).write.mode("append").parquet(str(path))


def run(spark, source, scoring, state):
    stream = st.read_stream(spark, str(source), "parquet", logs(spark, 0, 3).schema, max_files=1)
    return ms.write_model_scores(stream, scoring, str(state), available_now=True)


def test_equals_batch_scoring(spark, fitted, tmp_path):
    features, detector = fitted
    rows = logs(spark, 5000, 12 * 60)
    part = F.least(F.floor(F.hour("timestamp") / 3) + (F.col("row_id") % 5 == 0).cast("int"), F.lit(3))
    deliver(rows, tmp_path / "in", [part == i for i in range(4)])
    scoring = ms.ModelStream(features, detector, str(tmp_path / "out"), delay_minutes=6 * 60)
    run(spark, tmp_path / "in", scoring, tmp_path / "state").awaitTermination()
    before = ms.model_scores(spark, scoring.path).count()
    assert 0 < before < rows.count()
    scoring.finish(spark)
    want = {r.row_id: r.score for r in detector.score(features.transform(rows, stats="fitted"), bounds="fitted").collect()}
    got = {r.row_id: r.score for r in ms.model_scores(spark, scoring.path).collect()}
    assert got == pytest.approx(want)
    assert ms.stream_progress(spark, scoring.path).agg(F.sum("n_late")).first()[0] == 0


def test_late_rows_and_rows_without_a_time(spark, fitted, tmp_path):
    features, detector = fitted
    rows = logs(spark, 7000, 6 * 60)
    timeless = rows.limit(1).withColumns({"timestamp": F.lit(None).cast("timestamp"), "row_id": F.lit(1).cast("bigint")})
    deliver(rows, tmp_path / "in", [F.hour("timestamp") > 1])
    deliver(rows.where(F.hour("timestamp") <= 1).unionByName(timeless), tmp_path / "in", [F.lit(True)])
    scoring = ms.ModelStream(features, detector, str(tmp_path / "out"), delay_minutes=10)
    run(spark, tmp_path / "in", scoring, tmp_path / "state").awaitTermination()
    scoring.finish(spark)
    got = {r.row_id for r in ms.model_scores(spark, scoring.path).collect()}
    assert got == {1} | {r.row_id for r in rows.where(F.hour("timestamp") > 1).collect()}
    late = ms.stream_progress(spark, scoring.path).agg(F.sum("n_late")).first()[0]
    assert late == rows.where(F.hour("timestamp") <= 1).count()


def test_replay_after_a_failure(spark, fitted, tmp_path):
    """A micro-batch that fails after its writes is repeated, and nothing is doubled or lost."""
    features, detector = fitted
    rows = logs(spark, 9000, 9 * 60)
    deliver(rows, tmp_path / "in", [F.floor(F.hour("timestamp") / 3) == i for i in range(3)])

    class Failing(ms.ModelStream):
        def __call__(self, batch, batch_id):
            super().__call__(batch, batch_id)
            if batch_id == 1:
                raise RuntimeError("lost after the writes")

    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="lost after the writes"):
        run(spark, tmp_path / "in", Failing(features, detector, out), tmp_path / "state").awaitTermination()
    scoring = ms.ModelStream(features, detector, out)
    run(spark, tmp_path / "in", scoring, tmp_path / "state").awaitTermination()
    scoring.finish(spark)
    got = [r.row_id for r in ms.model_scores(spark, out).collect()]
    assert sorted(got) == sorted(r.row_id for r in rows.collect())
    assert sorted(r.batch_id for r in ms.stream_progress(spark, out).collect()) == [0, 1, 2, 3]
