"""Cleaning options reach validation; scores and sessions of odd kinds don't break."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from logloom.operators.evaluate import roc_auc
from logloom.operators.lookup import fits_broadcast
from logloom.operators.validate import validate
from logloom.plans import inputs as src
from logloom.plans import queries_models
from logloom.plans.runs import clean_logs
from logloom.functions.parsing import parse_lines


def test_syslog_rows_are_valid_with_a_year(spark, sf):
    parsed = parse_lines(src.raw_lines(spark, sf), "line")
    syslog = parsed.where("parse_method = 'syslog'")
    assert syslog.count() > 0
    assert validate(syslog).valid.count() == 0
    assert validate(syslog, default_year=2024).quarantined.count() == 0
    clean, _ = clean_logs(parsed, dedup=False, default_year=2024)
    assert clean.where("parse_method = 'syslog'").count() == syslog.count()


def test_upper_year(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "INFO", "s", "m"), ("9000-01-01 00:00:00", "INFO", "s", "m")],
        "timestamp string, level string, service string, message string",
    )
    assert validate(rows, max_year=2100).valid.count() == 1


def test_nan_scores_do_not_raise(spark):
    rows = spark.createDataFrame(
        [(1, 0.9), (0, 0.1), (1, float("nan")), (0, 0.3)] * 5, "y_true int, score double"
    )
    assert roc_auc(rows).count() == 1


def test_session_without_a_checkpoint_folder(tmp_path):
    code = (
        "from logloom.session import get_session, materialize\n"
        "s = get_session('t', master='local[1]', spark__ui__enabled='false')\n"
        "print('rows', materialize(s.range(3)).count())\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert "rows 3" in said.stdout, said.stderr[-500:]


def test_score_batch_trains_on_syslog_lines(spark, sf, monkeypatch):
    seen = {}

    def kept(name):
        real = getattr(queries_models, name)

        def run(*args, **options):
            seen[name] = real(*args, **options)
            return seen[name]

        monkeypatch.setattr(queries_models, name, run)

    kept("train_run")
    kept("score_batch_run")
    queries_models.score_batch(spark, sf)
    syslog = src.raw_lines(spark, sf).where("row_id % 5 = 2").join(src.logs(spark, sf).select("row_id", "timestamp"), "row_id")
    old = syslog.where("timestamp < '2024-01-16'").select("row_id")
    run, (scored, _) = seen["train_run"], seen["score_batch_run"]
    assert old.count() > 0
    assert run.quarantined.join(old, "row_id").count() == 0
    assert run.clean.where("parse_method = 'syslog'").join(old, "row_id").count() > 0
    years = scored.where("parse_method = 'syslog'").selectExpr("year(timestamp) AS y").distinct().collect()
    assert [r.y for r in years] == [2024]


def test_score_batch_parses_each_line_once(spark, sf, monkeypatch):
    lines, real = [], queries_models.parse_lines
    monkeypatch.setattr(queries_models, "parse_lines", lambda df: lines.append(df) or real(df))
    queries_models.score_batch(spark, sf)
    parsed = sorted(r.row_id for df in lines for r in df.select("row_id").collect())
    old = src.logs(spark, sf).where("timestamp < '2024-01-16'")
    assert len(lines) == 2 and lines[0].count() == old.count()
    assert parsed == sorted(r.row_id for r in src.logs(spark, sf).select("row_id").collect())


def test_arrays_count_as_bytes(spark):
    """A few rows with long arrays are too large to broadcast, however short the table is."""
    rows = spark.range(10).select("id", F.array_repeat(F.lit("x" * 100), 1000).alias("words"), F.struct(F.lit("y" * 50).alias("s")).alias("st"))
    assert fits_broadcast(rows)
    assert not fits_broadcast(rows, max_bytes=500_000) and fits_broadcast(rows, max_bytes=2_000_000)
    maps = rows.select(F.create_map(F.lit("k"), "words").alias("m"))
    assert not fits_broadcast(maps, max_bytes=500_000)
    assert fits_broadcast(rows.where("false"), max_bytes=0)


def test_scratch_is_removed_on_request(tmp_path):
    """Only what the process made goes; a session of its own, as other tests still read theirs."""
    code = (
        "import sys, os; sys.path.insert(0, sys.argv[1])\n"
        "from logloom.session import clear_scratch, get_session, materialize\n"
        "spark = get_session('t', 'local[2]', spark__ui__enabled='false', spark__checkpoint__dir=sys.argv[2])\n"
        "os.makedirs(sys.argv[2] + '/other')\n"
        "n = [materialize(spark.range(5)).count() for _ in range(3)]\n"
        "held = lambda: sorted(x.split('-')[0] for x in os.listdir(sys.argv[2]) if x[:5] in ('other', 'table'))\n"
        "print('left', n, held(), clear_scratch(spark), held(), clear_scratch(spark))\n"
    )
    root = str(Path(__file__).resolve().parents[1])
    out = subprocess.run([sys.executable, "-c", code, root, str(tmp_path / "s")], capture_output=True, text=True, timeout=200)
    assert "left [5, 5, 5] ['other', 'table', 'table', 'table'] 3 ['other'] 0" in out.stdout, out.stderr[-2000:]
