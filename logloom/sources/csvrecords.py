"""CSV records that may hold line breaks, read from splits of large files.

A line break belongs to a record or ends one, depending on how many quotes stand before it
in the file.  Whether that number is even at the start of a split is the parity of the quotes of all
splits before it, one number per split.  Each split then cuts its own lines into records; what is
left open at its ends (at most one piece at either end) is put together across splits afterwards.
So a file of any size is read by all of its splits; a task takes splits of up to ``TASK_BYTES`` one after the other,
so that small splits don't cost a task each.

Defined results: quotes are doubled inside quoted cells; a blank line outside quotes is no
record; a carriage return before a line break that ends a record is no part of it; the first record of a
file is its header, and files may have different headers; a record with too many cells is dropped, one with too few is filled
with NULL; an unclosed quote at the end of a file ends there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.operators.lookup import fits_broadcast
from logloom.session import materialize, ship_package

MAX_HEADERS = 1000
TASK_BYTES = 32 * 1024 * 1024
_CORRUPT = "_corrupt_record"

_PIECES = "file string, start bigint, no bigint, kind string, text string"


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines in file order to pieces: whole records, and the open pieces at the ends of each split.

    ``head`` goes on with a record of an earlier split (``last`` if it ends there), ``tail`` is a record that
    goes on in the next split.
    """
    now = None  # file and start of the split
    held: list[str] = []
    inside = began_open = False
    no, out = 0, []

    def close(kind: str) -> None:
        nonlocal held, no
        out.append((now[0], now[1], no, kind, "\n".join(held)))
        held, no = [], no + 1

    def leave() -> None:
        # The split ends inside a record: of this split, or one that it never saw the start of.
        if held:
            close("head" if began_open else "tail")

    for pdf in batches:
        for file, start, odd, line in zip(pdf["file"], pdf["start"], pdf["odd"], pdf["line"]):
            if now != (file, start):
                if now is not None:
                    leave()
                now, held, no, inside = (file, start), [], 0, bool(odd)
                began_open = inside
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                if began_open:
                    close("last")
                    began_open = False
                elif len(held) > 1 or line.strip():
                    close("record")
                else:
                    held = []
        if out:
            yield pd.DataFrame(out, columns=["file", "start", "no", "kind", "text"])
            out = []
    if now is not None:
        leave()
    if out:
        yield pd.DataFrame(out, columns=["file", "start", "no", "kind", "text"])


def _few_tasks(lines: DataFrame) -> DataFrame:
    """The same splits, several in a task where they are small."""
    spark = lines.sparkSession
    split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    splits = lines.rdd.getNumPartitions()
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-splits * split_bytes // TASK_BYTES))
    return lines.coalesce(tasks) if tasks < splits else lines


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, start, no, text)``: one row per record; (start, no) orders the records of a file."""
    ship_package(spark)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")
    )
    lines = _few_tasks(lines)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("q"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = materialize(splits.select("file", "start", (F.coalesce(F.sum("q").over(before), F.lit(0)) % 2).alias("odd")), "quote-parity")
    # One row per split: joined by broadcast when it is small, and without moving lines past each other.
    if fits_broadcast(odd):
        known = lines.join(F.broadcast(odd), ["file", "start"])
    else:
        placed = lines.withColumn("_at", F.monotonically_increasing_id()).join(odd, ["file", "start"])
        known = placed.repartition("file", "start").sortWithinPartitions("file", "start", "_at")
    pieces = _few_tasks(materialize(known.select("file", "start", "odd", "line").mapInPandas(_pieces, _PIECES), "csv-pieces"))

    whole = pieces.where("kind = 'record'").select("file", "start", "no", "text")
    in_file = Window.partitionBy("file").orderBy("start", "no")
    ends = pieces.where("kind <> 'record'").withColumn("group", F.sum((F.col("kind") == "tail").cast("int")).over(in_file))
    joined = ends.groupBy("file", "group").agg(
        F.min(F.struct("start", "no")).alias("at"), F.sort_array(F.collect_list(F.struct("start", "no", "text"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return whole.unionByName(joined.select("file", "at.start", "at.no", text.alias("text")))


def _cells(width: int) -> Callable:
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
    schema = T.StructType([*fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}
    body = F.regexp_replace("text", "\r$", "")
    return F.from_csv(body, schema.simpleString(), options)


def _header_cells(line: str) -> list[str]:
    import csv

    return next(csv.reader([line.rstrip("\r")]), [])


def read_csv_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All records under the names of their file's header; a column that a file lacks is NULL."""
    from logloom.sources.readers import normalize_header

    records = _few_tasks(materialize(read_records(spark, paths), "csv-records"))
    # A row per split first: numbers are hashed, where texts and structs would be sorted.
    starts = records.groupBy("file", "start").agg(F.min("no").alias("no"))
    at = starts.groupBy("file").agg(F.min(F.struct("start", "no")).alias("at")).select("file", "at.start", "at.no")
    first = records.join(at, ["file", "start", "no"]).select("file", F.col("text").alias("header"), F.struct("start", "no").alias("at"))
    first = materialize(first, "csv-headers")
    headers = [r["header"] for r in first.select("header").distinct().limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    body = records.join(first, "file").where(F.struct("start", "no") > F.col("at"))
    parts = []
    for header in headers:
        names = normalize_header(_header_cells(header))
        rows = body.where(F.col("header") == header).select("file", "start", "no", F.inline(F.array(_cells(len(names)))))
        too_many = F.col(_CORRUPT).isNotNull() & F.col(f"c{len(names) - 1}").isNotNull()
        kept = rows.where(~too_many)
        parts.append(kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]))
    if not parts:
        return spark.createDataFrame([], "line string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
