from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from logloom.plans import inputs as src
from logloom.plans.runs import evaluate_run, score_batch, track_run, train_run
from logloom.functions.parsing import parse_lines
from logloom.sources import store


def features(spark, n):
    return spark.range(n).select(F.col("id").alias("row_id"), F.array(F.col("id") * 1.0).alias("features"))


def test_feature_versions(spark, tmp_path):
    fs = store.FeatureStore(spark, str(tmp_path / "fs"))
    assert fs.metadata().count() == 0
    with pytest.raises(FileNotFoundError):
        fs.load("training")
    fs.save(features(spark, 3), ["a"], version="v_1", extra={"num_records": 3})
    fs.save(features(spark, 5), ["a"], version="v_2")
    fs.save(features(spark, 7), ["b"], dataset="other")
    table, names = fs.load("training")
    assert table.count() == 5 and names == ["a"]
    assert fs.load("training", "v_1")[0].count() == 3
    with pytest.raises(FileNotFoundError):
        fs.load("training", "v_9")
    listed = fs.versions("training").collect()
    assert [r.version for r in listed] == ["v_2", "v_1"] and listed[1].n_rows == 3
    assert fs.versions().count() == 3
    assert fs.versions("other").first().version.startswith("v_")


def test_two_writers_and_a_lost_one(spark, tmp_path):
    """Each save is a version of its own; what was not committed is not seen."""
    fs = store.FeatureStore(spark, str(tmp_path / "fs"))
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda n: fs.save(features(spark, n), ["a"]), (2, 3, 4, 5)))
    assert len(set(made)) == 4
    assert sorted(fs.load("training", v)[0].count() for v in made) == [2, 3, 4, 5]

    def lost(paths):
        raise RuntimeError("lost before the commit")

    with pytest.raises(RuntimeError):
        fs.tables.save("training", {"features": features(spark, 9)}, lost)
    store.write_text(spark, str(tmp_path / "fs/manifests/training/v_z.json"), '{"group_name": "training", "version": "v_z", "pa')
    assert {r.version for r in fs.versions("training").collect()} == set(made)
    assert fs.load("training")[0].count() == fs.load("training", max(made))[0].count()

    fs.save(features(spark, 6), ["a"], version="v_same")
    with pytest.raises(FileExistsError):
        fs.save(features(spark, 7), ["a"], version="v_same")
    assert fs.load("training", "v_same")[0].count() == 6
    with pytest.raises(ValueError):
        fs.save(features(spark, 1), ["a"], version="../outside")


def test_partitioned_sinks(spark, sf, tmp_path):
    rows = src.logs(spark, sf)
    store.write_clean(rows, str(tmp_path / "clean"))
    back = spark.read.parquet(str(tmp_path / "clean"))
    assert back.count() == rows.count()
    day = back.where("event_date = '2024-01-05'")
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().executedPlan().toString()
    store.write_quarantine(rows.limit(2).withColumn("reasons", F.array(F.lit("x"))), str(tmp_path / "q"), "2024-02-01")
    store.write_quarantine(rows.limit(3).withColumn("reasons", F.array(F.lit("y"))), str(tmp_path / "q"), "2024-02-02")
    assert spark.read.parquet(str(tmp_path / "q")).count() == 5


def test_reports_and_runs(spark, tmp_path):
    metrics = spark.createDataFrame([("f1", 0.5)], "name string, value double")
    store.save_report(metrics, str(tmp_path / "r"), "labeled", "v1")
    store.save_report(metrics.withColumn("value", F.lit(0.7)), str(tmp_path / "r"), "labeled", "v2")
    from logloom.sources.readers import latest_report

    newest = latest_report(spark.read.parquet(str(tmp_path / "r")), "version", "report").first()
    assert newest.value == 0.7
    store.record_run(spark, str(tmp_path / "runs"), "m", "v1", 10, 3, {"n": 5}, {"f1_score": 0.5, "roc_auc": None})
    run = spark.read.parquet(str(tmp_path / "runs")).first()
    assert run.run_name == "m_v1" and run.params == {"n": "5"} and run.metrics["roc_auc"] is None


def test_training_run_and_batch(spark, sf, tmp_path):
    labels = src.logs(spark, sf).select("row_id", "is_anomaly")
    parsed = parse_lines(src.raw_lines(spark, sf), "line").drop("is_anomaly").join(labels, "row_id")
    run = train_run(parsed, max_features=40, n_estimators=20, clean_options={"default_year": 2024})
    n = run.clean.count()
    assert n + run.quarantined.count() <= parsed.count()
    scored = run.scored
    assert scored.count() == n and scored.where("anomaly_label NOT IN (-1, 1)").count() == 0
    share = scored.where("is_anomaly_detected").count() / n
    assert 0 < share <= 0.08
    reports = evaluate_run(run)
    assert reports["confusion"].first().total_samples == n
    assert 0 <= reports["roc_auc"].first().roc_auc <= 1
    assert reports["threshold_table"].count() == 5 and reports["histogram"].count() == 50
    track_run(run, reports, str(tmp_path / "runs"))
    tracked = spark.read.parquet(str(tmp_path / "runs")).first()
    assert tracked.model_name == "isolation_forest" and "f1_score" in tracked.metrics
    lines = spark.createDataFrame(
        [(1, "2024-01-20 10:00:00 [CRITICAL] db: " + "!" * 400), (2, "2024-01-20 10:00:01 [INFO] svc-1: view user_id=1 took 5ms /api/v1/view")],
        "row_id bigint, line string",
    )
    rows, summary = score_batch(parse_lines(lines), run.features, run.detector, "fitted", "fitted")
    by = {r.row_id: r for r in rows.collect()}
    assert by[1].anomaly_score > by[2].anomaly_score
    assert summary.first().total_logs == 2
    one, _ = score_batch(parse_lines(lines.where("row_id = 1")), run.features, run.detector)
    alone = one.first()
    assert (alone.anomaly_score, alone.confidence) == (0.5, 0.0)
