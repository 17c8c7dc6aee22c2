"""Keep-first by event time on streams of shuffled, late and repeated rows."""

import random

import pytest
from pyspark.sql import functions as F

from logloom.operators import dedup
from logloom.streaming import keep_first as kf
from logloom.streaming import streams as st
from logloom.streaming.keep_first import keep_first_stream

SCHEMA = "row_id bigint, timestamp timestamp, key string, other int, text string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, "row_id bigint, minute int, key string, other int, text string")
    ts = F.lit("2024-01-15 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("minute"))
    return df.select("row_id", ts.alias("timestamp"), "key", "other", "text")


def run(spark, tmp_path, deliveries, keys=("key",), **kw):
    source, out = tmp_path / "in", tmp_path / "out"
    for rows in deliveries:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(source))
        stream = st.read_stream(spark, str(source), "parquet", frame(spark, deliveries[0]).schema, 1)
        kept = keep_first_stream(stream, list(keys), **kw)
        # Every delivery is a run of its own, so state is read back from the checkpoint each time.
        st.write_stream(kept, str(out), str(tmp_path / "state"), available_now=True).awaitTermination()
    return spark.read.schema(kept.schema).parquet(str(out))


END = [[(-1, 100_000, "end", 0, "")], [(-2, 200_000, "end2", 0, "")]]


@pytest.mark.parametrize("keys", [("key",), ("key", "other")])
def test_equals_batch_whatever_arrives_first(spark, tmp_path, keys):
    rng = random.Random(7)
    rows = [(i, rng.randrange(50), rng.choice(["a", "b", None, "hot", "hot"]), rng.choice([1, None]), f"t{i}") for i in range(300)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = run(spark, tmp_path, [shuffled[:120], shuffled[120:], *END], keys, delay="2 hours").where("row_id >= 0")
    want = dedup.keep_first(frame(spark, rows), list(keys))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rows_without_a_time_and_repeats_after_release(spark, tmp_path):
    deliveries = [
        [(1, None, "n", 0, "x"), (2, 5, "a", 0, "late first"), (3, 3, "a", 0, "first")],
        [(4, 400, "z", 0, "moves time")],
        [(5, 401, "a", 0, "repeat"), (6, 402, "n", 0, "repeat of a row without a time")],
        *END,
    ]
    got = {r.row_id for r in run(spark, tmp_path, deliveries, delay="10 minutes").collect()}
    assert got >= {1, 3, 4} and not got & {2, 5, 6}


def test_forgotten_keys_count_again(spark, tmp_path):
    deliveries = [[(1, 0, "a", 0, "")], [(2, 100, "b", 0, "")], [(3, 101, "b", 0, "")], [(4, 600, "c", 0, "")], [(5, 601, "c", 0, "")], [(6, 602, "a", 0, "again")], *END]
    for minutes, again in ((60, True), (None, False)):
        got = {r.row_id for r in run(spark, tmp_path / str(minutes), deliveries, delay="1 minute", forget_minutes=minutes).collect()}
        assert (6 in got) == again and {1, 2, 4} <= got and not got & {3, 5}


def test_keys_share_groups(spark, tmp_path, monkeypatch):
    """Python is called for a bucket of keys: the state has a row per bucket, not one per key."""
    monkeypatch.setattr(kf, "BUCKETS", 8, raising=False)
    rows = [(i, i % 40, f"k{i % 200}", 0, f"t{i}") for i in range(300)]
    source = tmp_path / "in"
    for part in (rows[150:], rows[:150], *END):
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(source))
    stream = st.read_stream(spark, str(source), "parquet", frame(spark, rows).schema, 1)
    kept = keep_first_stream(stream, ["key"], "2 hours")
    query = st.write_stream(kept, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    groups = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert 0 < max(groups) <= 8
    got = spark.read.schema(kept.schema).parquet(str(tmp_path / "out")).where("row_id >= 0")
    want = dedup.keep_first(frame(spark, rows), ["key"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
