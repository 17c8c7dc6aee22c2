import random

import pytest
from pyspark.sql import functions as F

from logloom.functions import text as tx
from logloom.functions.timestamps import parse_timestamp
from logloom.operators import clean, dedup, validate

SCHEMA = "row_id bigint, timestamp string, level string, service string, message string"
T = "2024-01-15 10:30:15"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_split_and_report(spark):
    rows = [
        (0, T, "ERROR", "a", "fine"),
        (1, T, "bogus", "a", "level is repaired"),
        (2, T, "warn", "a", "lower case is kept"),
        (3, None, "INFO", "a", "no time"),
        (4, T, "INFO", "a", "  "),
        (5, "2019-12-31 23:59:59", "INFO", "a", "old"),
        (6, T, None, "a", "x" * 10_001),
        (7, T, "INFO", "a", "x" * 10_000),
    ]
    v = validate.validate(frame(spark, rows))
    assert {r.row_id: r.level for r in v.valid.collect()} == {0: "ERROR", 1: "INFO", 2: "warn", 7: "INFO"}
    reasons = {r.row_id: r.reasons for r in v.quarantined.collect()}
    assert reasons == {
        3: ["null_check", "timestamp"],
        4: ["null_check"],
        5: ["timestamp"],
        6: ["log_level", "message_length"],
    }
    report = {r.check: (r.passed, r.failed) for r in v.report.collect()}
    assert report == {
        "schema": (8, 0), "null_check": (6, 2), "log_level": (6, 2), "timestamp": (6, 2),
        "message_length": (7, 1), "overall": (4, 4),
    }


def test_empty_and_missing_column(spark):
    empty = validate.validate(frame(spark, []))
    assert empty.valid.count() == 0
    assert {r.pass_rate for r in empty.report.collect()} == {1.0}
    broken = validate.validate(frame(spark, [(0, T, "INFO", "a", "m")]).drop("service"))
    assert broken.valid.count() == 0 and broken.quarantined.count() == 1


def test_preprocess_columns(spark):
    rows = [(0, "2024-01-15 09:00:00", "critical", None, " a \x1b[1mb "), (1, "Jan 20 18:00:00", "x", "s", "c")]
    out = {
        r.row_id: r
        for r in clean.preprocess(
            frame(spark, rows).withColumn("source_ip", F.lit("")), default_year=2024
        ).collect()
    }
    assert out[0].message == "a b" and out[0].message_length == 3
    assert out[0].service == "unknown" and out[0].source_ip == "0.0.0.0" and out[0].has_ip == 0
    assert (out[0].level_numeric, out[1].level_numeric) == (4, 1)
    assert (out[0].day_of_week, out[0].hour_of_day, out[0].is_business_hours) == (0, 9, 1)
    assert (out[1].day_of_week, out[1].is_business_hours) == (5, 0)
    assert out[1].timestamp_raw == "Jan 20 18:00:00"


def test_fill_timestamp(spark):
    df = frame(spark, [(0, "nonsense", "INFO", "s", "m")])
    assert clean.normalize_timestamps(df).first().timestamp is None
    filled = clean.normalize_timestamps(df, fill=F.lit("2024-03-01").cast("timestamp"))
    assert filled.first().timestamp.year == 2024


def keep_first(rows, key):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0])):
        if key(r) not in seen:
            seen.add(key(r))
            out.append(r)
    return out


def random_rows(n, hot, seed):
    """Log rows of which a share ``hot`` are copies of one message."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        minute = rng.randrange(600)
        ts = f"2024-01-15 {minute // 60:02d}:{minute % 60:02d}:00" if rng.random() > 0.02 else None
        same = rng.random() < hot
        service = "hot" if same else rng.choice(["a", "b", None])
        message = "copy" if same else rng.choice(["m1", "m2", "", None, f"u{rng.randrange(40)}"])
        rows.append((rng.randrange(-(2**62), 2**62), ts, "INFO", service, message))
    return rows


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_deduplicate_against_brute_force(spark, hot):
    rows = random_rows(400, hot, 7)
    df = frame(spark, rows).withColumns(
        {
            "timestamp": F.col("timestamp").cast("timestamp"),
            "log_hash": F.sha2(F.coalesce("message", F.lit("null")), 256),
        }
    )
    first = keep_first(rows, lambda r: "null" if r[4] is None else r[4])
    want = {r[0] for r in keep_first(first, lambda r: (r[3], r[4]))}
    assert {r.row_id for r in dedup.deduplicate(df).select("row_id").collect()} == want
    removed = dedup.removed_count(df, ["service", "message"]).first()[0]
    assert removed == len(rows) - len({(r[3], r[4]) for r in rows})


@pytest.mark.parametrize("minutes", [1, 5, 30])
def test_window_dedup_against_brute_force(spark, minutes):
    rows = random_rows(500, 0.4, 11)
    df = frame(spark, rows).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    want, last = set(), {}
    for r in sorted((r for r in rows if r[1]), key=lambda r: (r[1], r[0])):
        at = int(r[1][11:13]) * 60 + int(r[1][14:16])
        key = (r[3], r[4])
        if key not in last or at - last[key] >= minutes:
            want.add(r[0])
        last[key] = at
    want |= {r[0] for r in rows if r[1] is None}
    got = dedup.deduplicate(df, hash_col=None, window_minutes=minutes).select("row_id").collect()
    assert {r.row_id for r in got} == want


def test_service_and_message_do_not_run_together(spark):
    rows = [(0, T, "INFO", "a", "b_c"), (1, T, "INFO", "a_b", "c"), (2, T, "INFO", None, ""), (3, T, "INFO", "", None)]
    df = frame(spark, rows).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert dedup.deduplicate(df).count() == 4


def test_date_range_reaches_the_scan(spark, tmp_path):
    rows = [(0, "2024-01-09 23:59:59", "a"), (1, "2024-01-10 00:00:00", "a"), (2, "2024-01-11 23:59:59", "a"),
            (3, "2024-01-12 00:00:00", "a"), (4, "2024-01-10 12:00:00", "b")]
    df = spark.createDataFrame(rows, "row_id int, timestamp string, service string")
    df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    picked = validate.date_range(table, "2024-01-10", "2024-01-11", "a")
    assert {r.row_id for r in picked.collect()} == {1, 2}
    assert validate.date_range(table).count() == 5
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "OrEqual(timestamp,2024-01-10" in plan


def test_requests(spark):
    rows = [(0, None, None, None, "m"), (1, T, "", "s", ""), (2, T, "", "s", "x" * 10_001)]
    df = frame(spark, rows).withColumn("source_ip", F.lit(None).cast("string"))
    got = validate.accept_requests(df, now=F.lit(T)).collect()
    assert [(r.row_id, r.timestamp, r.level, r.service, r.source_ip) for r in got] == [(0, T, "INFO", "unknown", "")]


def test_time_is_parsed_once_for_both_years(spark):
    rows = frame(spark, [(1, "Jan 15 00:00:01", "INFO", "a", "x"), (2, "1/Jan/2019:00:00:01 +0000", "INFO", "a", "x")])
    good = validate.valid_rows(rows, default_year=2024)
    assert good._jdf.queryExecution().optimizedPlan().toString().count("year(") == 1
    assert [r.row_id for r in good.collect()] == [1]


@pytest.mark.parametrize("end", ["", "\n", " ", "\r\n"])
def test_times_with_and_without_ends(spark, end):
    texts = ["2024-01-02 03:04:05", "Jan 2 03:04:05", "2/Jan/2024:03:04:05 +0000", "1/2/2024 3:04:05"]
    rows = spark.createDataFrame([(t + end,) for t in texts], "t string")
    got = rows.select(parse_timestamp("t", default_year=2024).cast("string").alias("v")).collect()
    assert {r.v for r in got} == {"2024-01-02 03:04:05"}


def test_capitals_of_plain_and_other_text(spark):
    texts = [chr(i) * 2 for i in range(128)] + ["Ärger IM Haus", "ΑΒγ", "Ⅷ", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plan = rows.select(tx.uppercase_ratio("t").alias("v"))
    want = F.regexp_count("t", F.lit(f"[{tx.UPPER}]")) / F.greatest(F.length("t"), F.lit(1))
    assert [r.v for r in plan.collect()] == [r.v for r in rows.select(want.alias("v")).collect()]
    assert "[A-Z]" in plan._jdf.queryExecution().optimizedPlan().toString()
