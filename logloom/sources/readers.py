"""Readers: text, CSV and JSON-lines logs into the canonical log table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.parsing import LinePattern, parse_lines
from logloom.functions.text import col, extract_ip, sha256_hex, strip
from logloom.sources.csvrecords import read_csv_records
from logloom.schema import LOG_COLUMNS, ROW_ID

# Accepted names of each field of a structured entry, best first.
ENTRY_ALIASES = {
    "timestamp": ["timestamp"],
    "level": ["level", "severity"],
    "service": ["service", "source"],
    "source_ip": ["source_ip", "ip", "remote_addr"],
    "message": ["message", "msg"],
    "is_anomaly": ["is_anomaly"],
}
ENTRY_DEFAULTS = {
    "timestamp": "",
    "level": "INFO",
    "service": "unknown",
    "source_ip": "",
    "message": "",
}

_CORRUPT = "_corrupt_record"
ENTRY_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for names in ENTRY_ALIASES.values() for name in names]
)


def with_row_id(df: DataFrame) -> DataFrame:
    """Attach the row key in reading order.

    Unique without a shuffle, and repeatable while the files and the split
    size stay the same.  Write the table once before several jobs use it.
    """
    return df.select(F.monotonically_increasing_id().alias(ROW_ID), "*")


def spread(df: DataFrame) -> DataFrame:
    """Share out an input that cannot be split into enough pieces.

    One small Parquet row group or one compressed text file is one task.  When
    there are fewer pieces than cores the rows are dealt out; a large table has
    more pieces than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# --- text --------------------------------------------------------------------


def read_lines(spark: SparkSession, paths: str | Sequence[str], stream: bool = False) -> DataFrame:
    """Non-blank stripped lines as ``line``; bad bytes become U+FFFD."""
    reader = spark.readStream if stream else spark.read
    df = reader.text(paths if isinstance(paths, str) or stream else list(paths))
    df = df.select(strip("value").alias("line")).where(F.col("line") != "")
    return df if stream else with_row_id(df)


def read_text_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    patterns: Sequence[LinePattern] | None = None,
    extras: bool = False,
) -> DataFrame:
    return parse_lines(read_lines(spark, paths), "line", patterns, extras)


def explode_text(df: DataFrame, text: str, key: str) -> DataFrame:
    """Multi-line text cells to one stripped line per row.

    The cell is stripped as a whole and cut at line feeds.  An empty cell
    gives one empty line.  ``line_no`` numbers the lines of a cell from 0.
    """
    lines = F.split(strip(F.coalesce(F.col(text), F.lit(""))), "\n")
    return df.select(key, F.posexplode(lines).alias("line_no", "line")).withColumn(
        "line", strip("line")
    )


def ingest_text(
    df: DataFrame, text: str, key: str, patterns: Sequence[LinePattern] | None = None
) -> DataFrame:
    """Parse multi-line text cells; keeps ``key`` and ``line_no``."""
    return parse_lines(explode_text(df, text, key), "line", patterns)


# --- structured entries ------------------------------------------------------


def normalize_entries(
    df: DataFrame, raw: Column | None = None, method: str = "json", keep: Sequence[str] = ()
) -> DataFrame:
    """Map entry columns with alternative names onto the canonical columns.

    A missing column and a NULL cell both fall through to the next alias and
    then to the default.  ``raw`` is the text the hash is taken of; without it
    the JSON text of all columns but ``keep``.
    """
    have = {c.lower(): c for c in df.columns}

    def pick(name: str) -> Column:
        found = [F.col(f"`{have[a]}`") for a in ENTRY_ALIASES[name] if a in have]
        if name == "is_anomaly":
            if not found:
                return F.lit(None).cast("int")
            flag = found[0].cast("string")
            return F.coalesce(
                flag.try_cast("double").cast("int"), flag.try_cast("boolean").cast("int")
            )
        return F.coalesce(*[c.cast("string") for c in found], F.lit(ENTRY_DEFAULTS[name]))

    if raw is None:
        body = [F.col(f"`{c}`") for c in df.columns if c not in keep]
        raw = F.to_json(F.struct(*body))
    fields = {
        "timestamp": pick("timestamp"),
        "level": F.upper(pick("level")),
        "service": pick("service"),
        "source_ip": extract_ip(pick("source_ip")),
        "message": pick("message"),
        "raw_log": raw,
        "log_hash": sha256_hex("raw_log"),
        "parse_method": F.lit(method),
        "is_anomaly": pick("is_anomaly"),
    }
    staged = df.select(
        *[F.col(f"`{c}`") for c in keep],
        *[fields[c].alias(c) for c in LOG_COLUMNS if c != "log_hash"],
    )
    return staged.withColumn("log_hash", fields["log_hash"]).select(*keep, *LOG_COLUMNS)


def parse_json_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Add ``entry`` (the decoded object) and ``ok``; other columns are kept.

    Only a JSON object is an entry; any other line has ``ok`` false.  Each line
    is decoded once, whatever filters follow.
    """
    schema = T.StructType([*ENTRY_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    decoded = F.from_json(F.col(line), schema, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = df.select("*", F.inline(F.array(F.struct(decoded.alias("entry")))))
    whole = F.col(line).startswith("{") & F.col(line).endswith("}")
    ok = F.coalesce(whole & F.col(f"entry.{_CORRUPT}").isNull(), F.lit(False))
    return rows.withColumn("ok", ok)


def _json_text(line: Column) -> Column:
    """The JSON text without white space between its tokens."""
    return F.regexp_replace(line, r'("(?:[^"\\]|\\.)*+")|\s+', "$1")


def ingest_json_lines(
    df: DataFrame, line: str = "line", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """JSON lines to (log rows, undecodable lines)."""
    text = strip(line)
    decoded = parse_json_lines(df.withColumn(line, text).where(F.col(line) != ""), line)
    good = decoded.where("ok").select(*keep, _json_text(F.col(line)).alias("_raw"), "entry.*")
    good = good.drop(_CORRUPT)
    logs = normalize_entries(good, raw=F.col("_raw"), method="json", keep=list(keep))
    return logs, decoded.where("NOT ok").select(*keep, line)


def read_json_logs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    lines = with_row_id(spark.read.text(paths).withColumnRenamed("value", "line"))
    return ingest_json_lines(lines, "line", keep=[ROW_ID])[0]


# --- CSV ---------------------------------------------------------------------


def normalize_header(names: Sequence[str]) -> list[str]:
    return [n.strip().lower().replace(" ", "_") for n in names]


def read_csv_table(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV with normalised header; rows with too many cells are dropped.

    Short rows are padded with NULL and kept.  ``multi_line`` is for cells with line breaks: records are then
    found from the splits of the files (csvrecords.py), and every file has a header of its own.
    """
    if multi_line:
        return read_csv_records(spark, paths if isinstance(paths, str) else list(paths))
    options = {"header": True, "escape": '"'}
    header = spark.read.options(**options).csv(paths).columns
    corrupt = "_corrupt_record"
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in header] + [T.StructField(corrupt, T.StringType())]
    )
    df = (
        spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt)
        .schema(schema)
        .csv(paths)
    )
    last = F.col(f"`{header[-1]}`")
    df = df.where(F.col(corrupt).isNull() | last.isNull()).drop(corrupt)
    return df.toDF(*normalize_header(header))


def normalize_csv(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return normalize_entries(df, method="csv", keep=keep)


def read_csv_logs(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    table = with_row_id(read_csv_table(spark, paths, multi_line))
    return normalize_csv(table, keep=[ROW_ID])


# --- dispatch ----------------------------------------------------------------


def detect_format(path: str) -> str:
    suffix = path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower() if "." in path else ""
    return {"csv": "csv", "json": "json", "jsonl": "json"}.get(suffix, "text")


def read_logs(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Choose the reader by suffix; an unknown suffix is read as raw lines.

    A missing path raises Spark's ``PATH_NOT_FOUND`` at once.
    """
    readers = {"csv": read_csv_logs, "json": read_json_logs, "text": read_text_logs}
    return readers[fmt or detect_format(path)](spark, path, **options)


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def ingest_stats(logs: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """Rows per parse method, and the number of rejected lines."""
    stats = logs.groupBy(F.col("parse_method").alias("kind")).agg(F.count("*").alias("n"))
    if rejected is not None:
        stats = stats.unionByName(
            rejected.agg(F.count("*").alias("n")).select(F.lit("parse_error").alias("kind"), "n")
        )
    return stats


def latest_report(reports: DataFrame, version: str = "version", name: str = "name") -> DataFrame:
    """The row set of the newest version per report name.

    The newest version per name is a small aggregate; the rows are selected
    by a join with it, so no row is sorted.
    """
    newest = reports.groupBy(name).agg(F.max(version).alias(version))
    return reports.join(newest, [name, version], "left_semi")


def as_text(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")
