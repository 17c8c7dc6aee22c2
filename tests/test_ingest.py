import re

import pytest
from samples import LINES
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from logloom.functions import text as tx
from logloom.functions.parsing import LinePattern, parse_lines
from logloom.functions.templates import template
from logloom.functions.timestamps import parse_timestamp
from logloom.functions.tokens import ngrams, tokens
from logloom.schema import LOG_COLUMNS
from logloom.sources import readers


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "c string").select(expr).first()[0]


def test_app_lines(lines):
    rows = {r.row_id: r for r in parse_lines(lines).collect()}
    assert [rows[i].level for i in range(5)] == ["ERROR", "INFO", "WARNING", "DEBUG", "CRITICAL"]
    assert rows[0].service == "auth-service" and rows[0].source_ip == "192.168.1.100"
    assert rows[2].message == "Slow query detected: 2500ms"
    assert all(r.parse_method == "app_log" and len(r.log_hash) == 64 for r in rows.values())
    assert set(LOG_COLUMNS) <= set(rows[0].asDict())


@pytest.mark.parametrize(
    "line, method, level, service, timestamp, message",
    [
        ("2024-01-15 10:30:15.25 [warn] no service here", "app_log", "WARN", None, "2024-01-15 10:30:15.25", "no service here"),
        ("Feb 22 10:30:15 server01 sshd[1234]: bad key", "syslog", "INFO", "sshd", "Feb 22 10:30:15", "bad key"),
        ("Feb 22 10:30:15 server01 cron: done", "syslog", "INFO", "cron", "Feb 22 10:30:15", "done"),
        ('1.2.3.4 - - [15/Jan/2024:10:00:00 +0000] "GET /a HTTP/1.1" 200 17', "access_log", "INFO", "unknown", "15/Jan/2024:10:00:00 +0000", None),
        ("we informed them at 2024-01-15T10:30:15", "fallback", "INFO", "unknown", "2024-01-15T10:30:15", None),
        ("a criticality and an error", "fallback", "CRITICAL", "unknown", "", None),
        ("", "fallback", "INFO", "unknown", "", None),
    ],
)
def test_shapes(spark, line, method, level, service, timestamp, message):
    row = parse_lines(spark.createDataFrame([(1, line)], "row_id int, line string")).first()
    assert (row.parse_method, row.level, row.service, row.timestamp) == (method, level, service, timestamp)
    assert row.message == (line if message is None else message)


def test_own_pattern_comes_first(spark):
    own = LinePattern("pipe", r"^(\w+)\|(\w+)\|(.*)", {"level": 1, "service": 2, "message": 3})
    row = parse_lines(
        spark.createDataFrame([("warn|db|slow",)], "line string"), patterns=[own]
    ).first()
    assert (row.parse_method, row.level, row.service, row.message) == ("pipe", "WARN", "db", "slow")
    assert row.timestamp == ""


def test_equal_lines_equal_hash(spark):
    df = spark.createDataFrame([("a b",), ("a b",), ("a c",)], "line string")
    assert parse_lines(df).select("log_hash").distinct().count() == 2


def test_text_blocks(spark):
    df = spark.createDataFrame([(1, "\n".join(LINES) + "\n"), (2, "")], "id int, text string")
    rows = readers.ingest_text(df, "text", "id").orderBy("id", "line_no").collect()
    assert [r.line_no for r in rows if r.id == 1] == [0, 1, 2, 3, 4]
    assert [r.parse_method for r in rows if r.id == 2] == ["fallback"]


def test_log_file(spark, tmp_path):
    f = tmp_path / "x.log"
    f.write_bytes("\n".join([*LINES[:2], "   ", "\tbad \xff byte\t"]).encode("latin-1"))
    rows = readers.read_logs(spark, str(f)).orderBy("row_id").collect()
    assert len(rows) == 3 and rows[2].parse_method == "fallback"
    assert rows[2].raw_log.startswith("bad")
    assert readers.detect_format("a/b.unknown") == "text"


def test_csv_file(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text(
        "Timestamp, Level ,service,Source IP,message,is_anomaly\n"
        "2024-01-15 10:30:15,error,auth,192.168.1.1,\"bad, worse\",1\n"
        "2024-01-15 10:30:16,info,api,,fine,0\n"
        "2024-01-15 10:30:17,info,api\n"
        "2024-01-15 10:30:18,info,api,,too,0,long,row\n"
    )
    rows = readers.read_logs(spark, str(f)).orderBy("timestamp").collect()
    assert [r.message for r in rows] == ["bad, worse", "fine", ""]
    assert (rows[0].level, rows[0].source_ip, rows[0].is_anomaly) == ("ERROR", "192.168.1.1", 1)
    assert rows[2].is_anomaly is None and rows[1].source_ip == ""


def test_json_file(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text(
        '{"timestamp": "t", "severity": "warn", "source": "s", "remote_addr": "x 1.2.3.4", "msg": "m"}\n'
        '\n{"message":"only"}\n{"message": "only"}\n{broken\n[1]\n{"a": 1} tail\n'
        '{"message": "n", "level": null, "is_anomaly": true}\n'
    )
    rows = readers.read_logs(spark, str(f)).collect()
    assert len(rows) == 4
    by = {r.message: r for r in rows}
    assert (by["m"].level, by["m"].service, by["m"].source_ip) == ("WARN", "s", "1.2.3.4")
    assert by["only"].level == "INFO" and by["only"].service == "unknown"
    assert by["n"].is_anomaly == 1
    assert len({r.log_hash for r in rows}) == 3  # spacing does not change the hash
    lines = readers.with_row_id(spark.read.text(str(f)).withColumnRenamed("value", "line"))
    good, bad = readers.ingest_json_lines(lines, "line", keep=["row_id"])
    stats = {r.kind: r.n for r in readers.ingest_stats(good, bad).collect()}
    assert stats == {"json": 4, "parse_error": 3}


def test_entries_without_fields(spark):
    df = spark.createDataFrame([("Something happened",)], "message string")
    row = readers.normalize_entries(df).first()
    assert (row.level, row.service, row.timestamp, row.source_ip) == ("INFO", "unknown", "", "")


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_logs(spark, str(tmp_path / "none.log"))


def test_union_of_batches(spark):
    a = spark.createDataFrame([(1, "x")], "row_id int, level string")
    b = spark.createDataFrame([(2, "y")], "row_id int, service string")
    assert readers.union_batches([a, b]).columns == ["row_id", "level", "service"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-15 10:30:15", "2024-01-15 10:30:15"),
        (" 2024-01-15   10:30:15 ", "2024-01-15 10:30:15"),
        ("2024-1-5 1:2:3", "2024-01-05 01:02:03"),
        ("2024-01-15T10:30:15Z", "2024-01-15 10:30:15"),
        ("2024-01-15T10:30:15.123456Z", "2024-01-15 10:30:15"),
        ("15/Jan/2024:10:30:15 +0200", "2024-01-15 08:30:15"),
        ("Jan  5 10:30:15", "1900-01-05 10:30:15"),
        ("01/15/2024 10:30:15", "2024-01-15 10:30:15"),
        ("2024-02-30 10:30:15", None),
        ("2024-01-15", None),
        ("not a time", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamps(spark, text, want):
    got = one(spark, F.date_format(parse_timestamp("c"), "yyyy-MM-dd HH:mm:ss"), text)
    assert got == want


def test_timestamp_options(spark):
    expr = F.year(parse_timestamp("c", default_year=2024))
    assert one(spark, expr, "Feb 29 10:00:00") == 2024
    assert one(spark, F.year(parse_timestamp("c", formats=["yyyy/MM/dd"])), "2023/05/06") == 2023


def test_text_functions(spark):
    nbsp = " "
    assert one(spark, tx.strip("c"), f"{nbsp}\t a b \n") == "a b"
    assert one(spark, tx.is_blank("c"), f" {nbsp}") is True
    assert one(spark, tx.clean_message("c"), "\x1b[31mRed\x1b[0m  \n text ") == "Red text"
    assert one(spark, tx.truncate("c", 10), "x" * 11) == "x" * 7 + "..."
    assert one(spark, tx.truncate("c", 10), "x" * 10) == "x" * 10
    assert one(spark, tx.word_count("c"), "") == 0
    assert one(spark, tx.special_char_ratio("c"), "a-bé ") == pytest.approx(0.2)
    assert one(spark, tx.uppercase_ratio("c"), "ABÉd") == pytest.approx(0.75)
    assert one(spark, tx.uppercase_ratio("c"), "") == 0
    masked = one(spark, tx.mask_pii("c"), "a.b@c.org 10.1.2.3 123-45-6789 1234 5678-12345678")
    assert masked == "[EMAIL_REDACTED] [IP_REDACTED] [SSN_REDACTED] [CC_REDACTED]"
    assert one(spark, tx.safe_divide(F.lit(1), F.lit(0), -1.0), "") == -1.0


def test_template(spark):
    got = one(
        spark,
        template("c"),
        "ip 10.0.0.1 id 123e4567-e89b-12d3-a456-426614174000 at 1700000000 took 1.5 s n 7 "
        "hash deadbeef k=v/w path /a/b",
    )
    assert got == (
        "ip <IP> id <UUID> at <TIMESTAMP> took <FLOAT> s n <NUM> hash <HEX> k=<VALUE> path <PATH>"
    )


def test_ngrams(spark):
    df = spark.createDataFrame([("The cat sat ON a mat_1 x",), ("",)], "c string")
    words = df.select(tokens("c").alias("w"))
    got = [r[0] for r in words.select(ngrams(F.col("w"))).collect()]
    assert got[0] == ["cat", "sat", "mat_1", "cat sat", "sat mat_1", "cat sat mat_1"]
    assert got[1] == []
    assert words.select(ngrams(F.col("w"), 2, 2)).first()[0] == ["cat sat", "sat mat_1"]


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c', named_struct('d', 3)) AS s")
    assert tx.flatten_columns(df).columns == ["a", "s.b", "s.c.d"]


def test_patterns_do_not_end_at_odd_separators(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:15 [INFO] s: a b\rc",)], "line string")
    assert parse_lines(df).first().message == "a b\rc"
    assert re.match(".*", "a b\rc").group() == "a b\rc"
