import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.operators import evaluate as ev
from logloom.operators import monitor as mo
from logloom.operators.lookup import fits_broadcast, lookup
from logloom.operators.ordered import exact_percentiles, prefix_sums, previous_time_gap, time_gaps


def values(n, seed, hot=0.4):
    """Numbers of which a share is one value."""
    rng = random.Random(seed)
    return [0.5 if rng.random() < hot else round(rng.uniform(-3, 3), 2) for _ in range(n)]


def frame(spark, data, schema="v double"):
    return spark.createDataFrame([(x,) for x in data], schema)


@pytest.mark.parametrize("cuts", [[], [0.5], [-2.0, -1.0, 0.0, 0.5, 1.0, 5.0]])
def test_prefix_sums(spark, cuts):
    data = values(300, 1)
    counts = frame(spark, data).groupBy("v").agg(F.count("*").alias("n"))
    got = {r.v: r.cum_n for r in prefix_sums(counts, "v", ["n"], cuts).collect()}
    assert got == {v: sum(x <= v for x in data) for v in set(data)}


def test_percentiles(spark):
    data = values(501, 2)
    ps = [0.0, 0.05, 0.25, 0.5, 0.9, 0.995, 1.0]
    rows = exact_percentiles(frame(spark, [*data, None]), "v", ps).collect()
    got = {r.p: r.percentile for r in rows}
    for p in ps:
        assert got[p] == pytest.approx(np.percentile(data, p * 100))
    assert exact_percentiles(frame(spark, [2.0]), "v", [0.3]).first().percentile == 2.0


def test_previous_time(spark):
    rng = random.Random(3)
    times = [1_700_000_000_000_000 + rng.choice([0, 0, rng.randrange(10**10)]) for _ in range(300)]
    ids = rng.sample(range(10**6), 300)
    df = spark.createDataFrame(list(zip(ids, times)), "row_id bigint, t bigint")
    df = df.select("row_id", F.timestamp_micros("t").alias("timestamp"))
    order = sorted(zip(times, ids))
    want = {order[0][1]: 0.0}
    for (a, _), (b, i) in zip(order, order[1:]):
        want[i] = (b - a) / 1e6
    got = df.join(previous_time_gap(df), "row_id", "left").fillna(0.0).collect()
    assert {r.row_id: r.inter_arrival_seconds for r in got} == pytest.approx(want)


def test_time_gaps_of_equal_times(spark):
    """Rows that share a time, or have none, are returned too."""
    df = spark.createDataFrame([(3, 10), (1, 10), (2, 14), (4, 14), (5, None)], "row_id bigint, t bigint")
    got = time_gaps(df.select("row_id", F.timestamp_seconds("t").alias("timestamp"))).collect()
    assert sorted(map(tuple, got)) == [(1, 0.0), (2, 4.0), (3, 0.0), (4, 0.0), (5, 0.0)]


@pytest.mark.parametrize("small", [True, False, None])
def test_lookup(spark, small):
    """A hot key, rare keys, an unknown key and NULL keys, by every join."""
    rng = random.Random(4)
    keys = [rng.choice(["hot"] * 30 + [f"k{i}" for i in range(40)] + [None]) for _ in range(500)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row_id bigint, k string")
    known = rows.where("k IS NOT NULL AND k <> 'k7'")
    table = known.groupBy("k").agg(F.count("*").alias("n"))
    got = lookup(rows, table, ["k"], {"n": -1}, small=small, parts=5).collect()
    assert len(got) == 500
    want = {i: -1 if k in (None, "k7") else keys.count(k) for i, k in enumerate(keys)}
    assert {r.row_id: r.n for r in got} == want


def test_broadcast_check(spark):
    assert fits_broadcast(spark.range(10), 10) and not fits_broadcast(spark.range(11), 10)
    long = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("k"))
    assert fits_broadcast(long, 10, 20_000) and not fits_broadcast(long, 10, 5_000)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "y_true int, y_pred int, score double")


def test_roc_auc(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.3), 0, rng.choice([0.1, 0.2, 0.5, rng.random()])) for _ in range(200)]
    pos = [s for t, _, s in rows if t]
    neg = [s for t, _, s in rows if not t]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert ev.roc_auc(labelled(spark, rows)).first().roc_auc == pytest.approx(want)
    assert ev.roc_auc(labelled(spark, [(0, 0, 0.1), (0, 1, 0.2)])).first().roc_auc is None


def test_confusion_without_predictions(spark):
    c = ev.confusion(labelled(spark, [(1, 0, 0.1), (0, 0, 0.2), (None, 1, 0.3)])).first()
    assert (c.total_samples, c.precision, c.recall, c.f1_score) == (2, 0.0, 0.0, 0.0)
    report = {r["class"]: r for r in ev.class_report(labelled(spark, [(1, 1, 0.1), (0, 0, 0.2)])).collect()}
    assert report["accuracy"].precision == 1.0 and report["Anomaly"].support == 1


def test_histogram(spark):
    data = values(200, 6)
    want, edges = np.histogram(data, bins=10)
    got = ev.histogram(frame(spark, data), "v", 10).orderBy("bin").collect()
    assert [r.n for r in got] == want.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())
    constant = ev.histogram(frame(spark, [2.0, 2.0]), "v", 4).orderBy("bin").collect()
    assert [r.n for r in constant] == [0, 0, 2, 0] and constant[0].low == 1.5


def ks(a, b):
    grid = sorted(set(a) | set(b))
    return max(abs(np.mean(np.array(a) <= g) - np.mean(np.array(b) <= g)) for g in grid)


def test_ks(spark):
    a, b = values(300, 8), [v + 0.3 for v in values(200, 9, hot=0.1)]
    row = ev.ks_drift(frame(spark, a), frame(spark, b), "v").first()
    assert row.statistic == pytest.approx(ks(a, b))
    assert row.mean_shift == pytest.approx(np.mean(b) - np.mean(a))
    assert row.drift_detected and row.p_value < 0.05
    same = ev.ks_drift(frame(spark, a), frame(spark, a), "v").first()
    assert same.statistic == 0 and same.p_value == 1.0 and not same.drift_detected


def test_ks_p_value_of_large_samples(spark):
    # The Kolmogorov distribution at 1.0 and 1.36.
    for lam, want in ((1.0, 0.27), (1.36, 0.0495)):
        n = 2.0 * 10_000
        p = spark.range(1).select(ev.ks_p_value(F.lit(lam / 100.0), F.lit(n), F.lit(n))).first()[0]  # beyond the exact range
        assert p == pytest.approx(want, abs=2e-3)


def test_compare_models(spark):
    rows = [("a", 0.5, 0), ("b", 0.7, 1), ("c", 0.7, 2)]
    df = spark.createDataFrame(rows, "model_name string, f1_score double, position int")
    assert tuple(ev.compare_models(df).first()) == ("b", 0.7)
    assert tuple(ev.compare_models(df.where("f1_score < 0")).first()) == (None, 0.0)


def predictions(spark, rows):
    df = spark.createDataFrame(rows, "row_id bigint, s int, latency_ms double, is_anomaly boolean, score double")
    return df.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s"))).drop("s")


def test_monitoring(spark):
    rows = [(i, i, 10.0 * (i + 1), False, 0.3) for i in range(5)]
    lat = mo.latency_statistics(predictions(spark, rows)).first()
    assert lat["mean"] == 30 and lat.p50 == 30 and lat.p90 == 46 and lat["max"] == 50
    none = predictions(spark, rows).where("row_id < 0")
    assert set(mo.latency_statistics(none).first()) == {0.0}
    m = mo.rolling_metrics(none).first()
    assert (m.total_predictions, m.window_rate, m.error_rate) == (0, 0.0, 0.0)
    assert mo.request_rate(predictions(spark, rows), seconds=3).first().requests == 3


def test_alerts(spark):
    p = predictions(spark, [(i, i, 10.0, i >= 80, 0.5) for i in range(100)])
    metrics, latency = mo.rolling_metrics(p, p.where("row_id < 20")), mo.latency_statistics(p)
    got = {(r.type, r.severity) for r in mo.check_alerts(metrics, latency).collect()}
    assert got == {("anomaly_rate", "WARNING"), ("error_rate", "CRITICAL")}
    calm = p.withColumn("is_anomaly", F.lit(False))
    assert mo.check_alerts(mo.rolling_metrics(calm), latency).count() == 0
    lines = mo.metric_lines(metrics, latency, text=True).orderBy("position").collect()
    assert lines[2].line == (
        "# HELP logloom_anomaly_rate Share of anomalous rows in the window\n"
        "# TYPE logloom_anomaly_rate gauge\nlogloom_anomaly_rate 0.200000"
    )


def test_drift_guard(spark):
    p = predictions(spark, [(i, i, 1.0, False, float(i)) for i in range(150)])
    reference = p.withColumn("score", F.col("score") - 500)
    assert mo.drift_check(p, None) is None
    assert mo.drift_check(p, reference, window=99).count() == 0
    assert mo.drift_check(p, reference).first().drift_detected
