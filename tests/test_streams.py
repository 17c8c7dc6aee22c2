import shutil
import time

import pytest
from pyspark.sql import functions as F

from logloom.functions.parsing import parse_lines
from logloom.models.registry import train
from logloom.operators.clean import preprocess
from logloom.operators.validate import validate
from logloom.streaming import streams as st

SCHEMA = "row_id bigint, timestamp timestamp, service string, level string, score double"


def write(spark, path, rows):
    df = spark.createDataFrame(rows, "row_id bigint, t string, service string, level string, score double")
    df.select("row_id", F.col("t").cast("timestamp").alias("timestamp"), "service", "level", "score").coalesce(1).write.mode("append").parquet(str(path))


def minute(m):
    return f"2024-01-15 {10 + m // 60:02d}:{m % 60:02d}:00"


def stream(spark, path, max_files=1):
    from pyspark.sql.types import _parse_datatype_string

    return st.read_stream(spark, str(path), "parquet", _parse_datatype_string(SCHEMA), max_files)


def run(df, out, state, **kw):
    q = st.write_stream(df, str(out), str(state), available_now=True, **kw)
    q.awaitTermination()
    return q


def test_split_stream_equals_batch(spark, tmp_path):
    lines = [f"2024-01-15 10:30:{i:02d} [{'ERROR' if i % 3 else 'bogus'}] svc{i % 2}: took {i}ms" for i in range(30)]
    lines += ["", "garbage", "Jan 15 10:00:00 host svc: m"]
    for k in range(3):
        d = tmp_path / "in"
        d.mkdir(exist_ok=True)
        (d / f"{k}.txt").write_text("\n".join(lines[k * 11 : k * 11 + 11]) + "\n")
    good, bad = st.clean_stream(st.parse_stream(st.lines_of(st.read_stream(spark, str(tmp_path / "in"), max_files=1))))
    run(good, tmp_path / "good", tmp_path / "s1")
    run(bad, tmp_path / "bad", tmp_path / "s2")
    batch = validate(parse_lines(st.lines_of(spark.read.text(str(tmp_path / "in"))), "line"))
    want = preprocess(batch.valid, dedup=False)
    got = spark.read.schema(good.schema).parquet(str(tmp_path / "good"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert spark.read.schema(bad.schema).parquet(str(tmp_path / "bad")).count() == batch.quarantined.count() == 2


def test_broker_shape(spark):
    df = spark.createDataFrame([(bytearray(b" a line "), 1)], "value binary, offset int")
    assert tuple(st.lines_of(df).first()) == (1, "a line")


def test_windows_and_late_rows(spark, tmp_path):
    src = tmp_path / "in"
    write(spark, src, [(i, minute(i), "a", "INFO", 0.9 if i == 3 else 0.1) for i in range(10)])
    rates = st.window_rates(stream(spark, src), "5 minutes", delay="2 minutes", flag=F.col("score") > 0.5)
    run(rates, tmp_path / "out", tmp_path / "state")
    write(spark, src, [(20, minute(30), "a", "INFO", 0.1)])
    run(rates, tmp_path / "out", tmp_path / "state")
    write(spark, src, [(21, minute(2), "a", "INFO", 0.1), (22, minute(60), "a", "INFO", 0.1)])
    run(rates, tmp_path / "out", tmp_path / "state")
    rows = spark.read.schema(rates.schema).parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.n, r.anomalies) for r in rows] == [(0, 5, 1), (5, 5, 0), (30, 1, 0)]
    assert rows[0].anomaly_rate == pytest.approx(0.2)


def test_sliding_windows(spark, tmp_path):
    src = tmp_path / "in"
    write(spark, src, [(i, minute(i), "a", "INFO", 0.1) for i in range(20)])
    rates = st.window_rates(stream(spark, src), "10 minutes", "5 minutes", "1 minute", flag=F.lit(False))
    run(rates, tmp_path / "out", tmp_path / "state")
    rows = spark.read.schema(rates.schema).parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [r.n for r in rows] == [5, 10, 10]


def test_dedup_and_restart(spark, tmp_path):
    src = tmp_path / "in"
    write(spark, src, [(1, minute(0), "a", "INFO", 0.1), (2, minute(1), "a", "INFO", 0.1), (3, minute(1), "b", "INFO", 0.1)])
    df = st.deduplicate_stream(stream(spark, src), ["service"], "5 minutes")
    run(df, tmp_path / "out", tmp_path / "state")
    run(df, tmp_path / "out", tmp_path / "state")  # nothing new: nothing added
    write(spark, src, [(4, minute(2), "a", "INFO", 0.1), (5, minute(30), "c", "INFO", 0.1)])
    run(df, tmp_path / "out", tmp_path / "state")
    write(spark, src, [(6, minute(31), "a", "INFO", 0.1)])  # the key left the state
    run(df, tmp_path / "out", tmp_path / "state")
    got = spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()
    services = sorted(r.service for r in got)
    assert services == ["a", "a", "b", "c"]


def test_scores_alerts_and_replay(spark, tmp_path):
    src = tmp_path / "in"
    for k in range(3):
        write(spark, src, [(10 * k + i, minute(i), "a", "ERROR", i / 10) for i in range(10)])
    scored = st.score_stream(stream(spark, src), lambda df: df.withColumn("anomaly_score", F.col("score")))
    args = (str(tmp_path / "scored"), str(tmp_path / "alerts"), str(tmp_path / "state"))
    for _ in range(2):
        st.write_scored_and_alerts(scored, *args, available_now=True).awaitTermination()
    assert spark.read.parquet(args[0]).count() == 30
    alerts = spark.read.parquet(args[1])
    assert alerts.count() == 12 and alerts.where("anomaly_score <= 0.5").count() == 0


def test_model_on_a_stream(spark, tmp_path):
    rows = [(i, minute(i), "a", "INFO", 100.0 if i == 7 else (i % 5) / 5) for i in range(50)]
    write(spark, tmp_path / "in", rows)
    static = spark.read.parquet(str(tmp_path / "in"))

    def features(df):
        return df.withColumn("features", F.array("score"))

    detector = train(features(static).select("row_id", "features"), n_estimators=20)
    scored = st.score_stream(stream(spark, tmp_path / "in"), st.model_scoring(detector, features))
    kept = scored.select("row_id", "anomaly_score", "is_anomaly_detected")
    run(kept, tmp_path / "out", tmp_path / "state")
    got = {r.row_id: r.anomaly_score for r in spark.read.schema(kept.schema).parquet(str(tmp_path / "out")).collect()}
    want = {r.row_id: r.anomaly_score for r in detector.score(features(static), "fitted").collect()}
    assert got == pytest.approx(want) and max(got, key=got.get) == 7


def test_heuristic_is_repeatable(spark):
    df = spark.range(4000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "ERROR").otherwise("INFO").alias("level"))
    a = {tuple(r) for r in st.heuristic_scores(df).collect()}
    assert a == {tuple(r) for r in st.heuristic_scores(df.repartition(3)).collect()}
    hits = [r for r in a if r[3]]
    assert all(r[1] == "ERROR" and 0.6 <= r[2] <= 0.95 for r in hits)
    assert 0.25 < len(hits) / 2000 < 0.35
    assert all(0.01 <= r[2] <= 0.4 for r in a if not r[3])


def test_totals_and_drift(spark, tmp_path):
    src = tmp_path / "in"
    write(spark, src, [(i, minute(i), "a", "INFO", float(i)) for i in range(40)])
    write(spark, src, [(i, minute(i), "a", "INFO", float(i + 500)) for i in range(40)])
    reference = spark.range(40).select(F.col("id").cast("double").alias("score"))
    st.write_drift(stream(spark, src).select("score"), reference, str(tmp_path / "drift"), str(tmp_path / "s1"), True).awaitTermination()
    drift = {r.batch: r.drift_detected for r in spark.read.parquet(str(tmp_path / "drift")).collect()}
    assert len(drift) == 2 and sorted(drift.values()) == [False, True]


def wait_for(totals, batches):
    """Progress events come a little after the micro-batch."""
    for _ in range(60):
        rows = totals().collect()
        if rows and rows[0].batches >= batches:
            return rows[0]
        time.sleep(0.5)
    raise AssertionError(rows)


def test_totals_over_many_batches_and_a_restart(spark, tmp_path):
    src, n = tmp_path / "in", 105
    write(spark, src, [(0, minute(0), "a", "INFO", 500.0)])
    one = next(p for p in src.iterdir() if p.suffix == ".parquet")
    for i in range(1, n):
        shutil.copy(one, src / f"copy-{i}.parquet")
    flagged = stream(spark, src).withColumn("is_anomaly_detected", F.col("score") > 100)
    listener = st.TotalsListener(spark, str(tmp_path / "totals"))
    spark.streams.addListener(listener)
    try:
        run(st.observed_totals(flagged), tmp_path / "out", tmp_path / "state")
        shutil.copy(one, src / "later.parquet")
        q = run(st.observed_totals(flagged), tmp_path / "out", tmp_path / "state")
        row = wait_for(lambda: st.recorded_totals(spark, str(tmp_path / "totals"), str(q.id)), n + 1)
    finally:
        spark.streams.removeListener(listener)
    assert (row.rows, row.consumed, row.anomalies_detected, row.late_rows) == (n + 1, n + 1, n + 1, 0)


def test_late_rows_are_counted(spark, tmp_path):
    src = tmp_path / "in"
    listener = st.TotalsListener(spark, str(tmp_path / "totals"))
    spark.streams.addListener(listener)
    try:
        for k, m in enumerate((0, 90, 95, 1, 200)):
            write(spark, src, [(k, minute(m), "a", "INFO", 0.1)])
        rates = st.window_rates(stream(spark, src), "5 minutes", delay="2 minutes", flag=F.lit(False))
        q = run(rates, tmp_path / "out", tmp_path / "state")
        row = wait_for(lambda: st.recorded_totals(spark, str(tmp_path / "totals"), str(q.id)), 5)
    finally:
        spark.streams.removeListener(listener)
    assert row.late_rows == 1 and row.rows == 5
