"""CSV records across splits against a plain reader of whole files."""

import csv
import io
import random

import pytest

from logloom.sources import csvrecords, readers


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "50")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), strict=False) if r]
    width = len(rows[0])
    return sorted(
        (tuple((c.replace("\r\n", "\n") or None) for c in r) + (None,) * (width - len(r)) for r in rows[1:] if len(r) <= width), key=str
    )


def write(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_text(out.getvalue(), newline="")
    return out.getvalue()


def cell(rng):
    parts = ["a", "b c", '"', "\n", "\n\n", ",", "ü漢", "word " * 5, '""', "x" * 40]
    return "v" + "".join(rng.choice(parts) for _ in range(rng.randrange(5))) + "w"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed, few_splits", [(1, True), (2, True), (3, False)])
def test_random_files(spark, small_splits, tmp_path, monkeypatch, seed, few_splits):
    """``few_splits``: their parities are broadcast; else lines are brought to them and ordered again."""
    monkeypatch.setattr(csvrecords, "fits_broadcast", lambda table: few_splits)
    rng = random.Random(seed)
    rows = [["time", "level", "text"]] + [[str(i), cell(rng), cell(rng)] for i in range(120)]
    rows[10:10] = [["short", "row"], ["one", "too", "many", "cells"]]
    text = write(tmp_path / "a.csv", rows)
    records = csvrecords.read_records(spark, str(tmp_path / "a.csv"))
    assert records.count() == len(rows)
    assert len({r.start for r in records.collect()}) > 10
    assert got(readers.read_csv_table(spark, str(tmp_path / "a.csv"), multi_line=True)) == plain(text)


def test_a_cell_larger_than_splits(spark, small_splits, tmp_path):
    rows = [["a", "b"], ["1", "v\n" * 900 + '"end"'], ["2", "x"]]
    text = write(tmp_path / "a.csv", rows)
    assert got(readers.read_csv_table(spark, str(tmp_path / "a.csv"), multi_line=True)) == plain(text)


def test_headers_of_their_own_and_line_ends(spark, tmp_path):
    write(tmp_path / "a.csv", [["Time", "Msg Text"], ["1", "x\ny"], ["2", "z"]], end="\r\n")
    write(tmp_path / "b.csv", [["msg_text", "level"], ["p", "INFO"], ["q\n", "WARN"]])
    df = readers.read_csv_table(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], multi_line=True)
    rows = {(r["time"], r["msg_text"], r["level"]) for r in df.collect()}
    assert rows == {("1", "x\ny", None), ("2", "z", None), (None, "p", "INFO"), (None, "q\n", "WARN")}


def test_blank_lines_open_quote_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n\n   \n1,"x\n\ny"\n\n2,"never closed\nand on')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("a,b\n")
    files = [str(tmp_path / f"{n}.csv") for n in "abc"]
    texts = {r.text for r in csvrecords.read_records(spark, files).collect()}
    assert texts == {"a,b", '1,"x\n\ny"', '2,"never closed\nand on'}
    assert readers.read_csv_table(spark, files, multi_line=True).where("a = '1'").first()["b"] == "x\n\ny"
    assert readers.read_csv_table(spark, files[1], multi_line=True).count() == 0
    assert readers.read_csv_table(spark, files[2], multi_line=True).count() == 0
    logs = readers.read_csv_logs(spark, files[0], multi_line=True)
    assert logs.count() == 2


def test_small_splits_share_tasks(spark, small_splits, tmp_path, monkeypatch):
    rows = [["a", "b"]] + [[str(i), "x\ny " * (i % 7) + "w"] for i in range(600)]
    text = write(tmp_path / "a.csv", rows)
    tasks, written = {}, csvrecords.materialize

    def noted(df, purpose):
        tasks[purpose] = df.rdd.getNumPartitions()
        return written(df, purpose)

    monkeypatch.setattr(csvrecords, "materialize", noted)
    assert got(readers.read_csv_table(spark, str(tmp_path / "a.csv"), multi_line=True)) == plain(text)
    assert len(text) // 200 > 30 and tasks["csv-pieces"] <= 2 * spark.sparkContext.defaultParallelism
