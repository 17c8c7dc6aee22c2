"""Queries of readers, stores and registries: rows written by Spark, read back by the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions.parsing import DEFAULT_PATTERNS, LinePattern
from logloom.functions.parsing import parse_lines as parse
from logloom.functions.templates import template
from logloom.models.registry import Detector, model_versions, train
from logloom.operators import monitor, validate
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.plans.queries_ingest import parsed_sql
from logloom.session import scratch_dir
from logloom.sources import readers, store

COLUMNS = ["timestamp", "level", "service", "source_ip", "message", "parse_method"]
SHOWN = '"timestamp", level, service, source_ip, message, parse_method'
# Rows of a written CSV file, about.
CSV_FILE_ROWS = 500_000
TEXT_TIME = """strftime("timestamp", '%Y-%m-%d %H:%M:%S')"""


def _text_file(df, purpose, column="line"):
    path = scratch_dir(df.sparkSession, purpose)
    df.select(F.col(column).alias("value")).write.text(path)
    return path


def _timed(logs):
    return logs.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query(f"WITH {src.RAW_LINES} SELECT {SHOWN} FROM ({parsed_sql('raw_lines', 'row_id')})")
def read_text_file(spark, sf):
    """Raw lines through text files."""
    return readers.read_text_logs(spark, _text_file(src.raw_lines(spark, sf), "text-logs")).select(*COLUMNS)


def _json_file(spark, sf):
    logs = _timed(src.logs(spark, sf)).select(
        F.to_json(F.struct("timestamp", F.lower("level").alias("severity"), F.col("service").alias("source"), "message")).alias("line")
    )
    bad = logs.limit(1).select(F.lit("{not json").alias("line"))
    return _text_file(logs.unionByName(bad), "json-logs")


@query(
    f"""WITH {src.LOGS} SELECT {TEXT_TIME} AS "timestamp", level, service, message, 'json' AS parse_method FROM logs"""
)
def read_json_file(spark, sf):
    """JSON lines with other names and one broken line, through files."""
    rows = readers.read_json_logs(spark, _json_file(spark, sf))
    return rows.select("timestamp", "level", "service", "message", "parse_method")


def _csv_file(spark, sf):
    """Files with two different headers, line breaks and quotes inside cells, short and long records."""
    logs = _timed(src.logs(spark, sf))
    message = F.when(F.col("row_id") % 3 == 0, F.concat(F.lit('say "hi",\n'), "message", F.lit("\n\nend"))).otherwise(F.col("message"))

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    cells = {"timestamp": F.col("timestamp"), "level": F.col("level"), "service": F.col("service"), "message": quoted(message)}
    base = scratch_dir(spark, "csv-logs")
    files = -(-logs.count() // (2 * CSV_FILE_ROWS)) or 1
    for part, names, header in (
        (0, ["timestamp", "level", "service", "message"], "Timestamp,Level,Service,Message"),
        (1, ["message", "service", "timestamp", "level"], "message, service ,timestamp,level"),
    ):
        rows = logs.where(F.col("row_id") % 2 == part)
        line = F.concat_ws(",", *[cells[n] for n in names])
        odd = F.when(F.col("row_id") % 50 == 48, F.concat(line, F.lit(",one too many"))).when(
            F.col("row_id") % 50 == 46, F.concat_ws(",", *[cells[n] for n in names[:3]])
        )
        body = rows.select(F.pmod(F.xxhash64("row_id"), F.lit(files)).alias("file"), "row_id", F.coalesce(odd, line).alias("line"))
        first = spark.range(files).select(F.col("id").alias("file"), F.lit(None).cast("bigint").alias("row_id"), F.lit(header).alias("line"))
        # The header has no row key, so it sorts first in each file.
        whole = first.unionByName(body).repartition(files, "file").sortWithinPartitions("file", "row_id")
        whole.select("file", "line").write.partitionBy("file").text(f"{base}/{part}")
    return [f"{base}/{part}/file={i}" for part in (0, 1) for i in range(files)]


@query(
    f"""WITH {src.LOGS} SELECT {TEXT_TIME} AS "timestamp", level, service,
    CASE WHEN row_id % 50 = 46 THEN NULL WHEN row_id % 3 = 0 THEN 'say "hi",' || chr(10) || message || chr(10) || chr(10) || 'end' ELSE message END AS message
    FROM logs WHERE row_id % 50 <> 48"""
)
def read_csv_file(spark, sf):
    """CSV files with quoted line breaks and two headers; small splits cut records apart."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    paths = _csv_file(spark, sf)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        rows = readers.read_csv_table(spark, paths, multi_line=True).select("timestamp", "level", "service", "message")
        return rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@query(
    f"""WITH {src.RAW_LINES} SELECT kind, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT parse_method AS kind, count(*) AS n FROM ({parsed_sql('raw_lines', 'row_id')}) GROUP BY 1
      UNION ALL SELECT 'json', count(*) FROM logs) GROUP BY kind"""
)
def read_by_suffix(spark, sf):
    """Readers chosen by the suffix of the path, their rows put together and counted."""
    base = scratch_dir(spark, "suffix")
    src.raw_lines(spark, sf).select(F.col("line").alias("value")).write.text(f"{base}/app.log")
    spark.read.text(_json_file(spark, sf)).write.text(f"{base}/app.jsonl")
    rows = readers.union_batches([readers.read_logs(spark, f"{base}/app.log"), readers.read_logs(spark, f"{base}/app.jsonl")])
    return readers.ingest_stats(rows)


@query(
    f"""WITH {src.DIRTY} SELECT row_id, '2024-02-0' || CAST(1 + row_id % 2 AS VARCHAR) AS ingest_date FROM dirty
    WHERE "timestamp" IS NULL OR trim("timestamp") = '' OR message IS NULL OR trim(message) = '' OR length(message) > 10000
      OR NOT coalesce(year(try_strptime(trim("timestamp"), '%Y-%m-%d %H:%M:%S')) >= 2020, false)"""
)
def quarantine_roundtrip(spark, sf):
    """Bad rows kept by ingest date, and read back."""
    path = scratch_dir(spark, "quarantine")
    bad = validate.quarantined_rows(src.dirty_logs(spark, sf))
    for day in (1, 2):
        store.write_quarantine(bad.where(F.col("row_id") % 2 == day - 1), path, f"2024-02-0{day}")
    back = spark.read.parquet(path).where(F.size("reasons") > 0)
    return back.select("row_id", F.col("ingest_date").cast("string").alias("ingest_date"))


@query(f"""WITH {src.LOGS} SELECT row_id, message FROM logs WHERE CAST("timestamp" AS DATE) = DATE '2024-01-05'""")
def clean_roundtrip(spark, sf):
    """Clean rows kept by event date; one day read back."""
    path = scratch_dir(spark, "clean")
    store.write_clean(src.logs(spark, sf), path)
    return spark.read.parquet(path).where("event_date = '2024-01-05'").select("row_id", "message")


@query(
    """SELECT version, CAST(n_rows AS BIGINT) AS n_rows, CAST(64 AS BIGINT) AS n_features, round(total, 4) AS total FROM (
      SELECT 'v_1' AS version, count(*) AS n_rows, sum(list_sum(embedding::DOUBLE[])) AS total FROM embeddings WHERE label < 5
      UNION ALL SELECT 'v_2', count(*), sum(list_sum(embedding::DOUBLE[])) FROM embeddings)"""
)
def feature_store_roundtrip(spark, sf):
    """Two versions of a feature table, saved, listed and loaded."""
    rows = src.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("features"), "label"
    )
    fs = store.FeatureStore(spark, scratch_dir(spark, "features"))
    names = [f"x{i}" for i in range(64)]
    fs.save(rows.where("label < 5").drop("label"), names, version="v_1")
    fs.save(rows.drop("label"), names, version="v_2")
    sums = [
        fs.load("training", v)[0].agg(F.sum(F.aggregate("features", F.lit(0.0), lambda a, x: a + x)).alias("total")).withColumn("version", F.lit(v))
        for v in ("v_1", "v_2")
    ]
    totals = sums[0].unionByName(sums[1])
    return fs.versions("training").join(totals, "version").select("version", "n_rows", "n_features", F.round("total", 4).alias("total"))


def _saved_models(spark, sf):
    rows = src.vectors(spark, sf)
    base = scratch_dir(spark, "models")
    forest = train(rows, "isolation_forest", n_estimators=20)
    forest.save(spark, base, "v1")
    svm = train(rows, "one_class_svm", iterations=3)
    svm.save(spark, base, "v1")
    forest.save(spark, base, "v2")
    return rows, base, {"isolation_forest": forest, "one_class_svm": svm}


@query("SELECT vec_id AS row_id, m AS model_name, TRUE AS same_score FROM embeddings, (VALUES ('isolation_forest'), ('one_class_svm')) t(m)")
def model_roundtrip(spark, sf):
    """Scores of loaded models against those of the models that were saved."""
    rows, base, models = _saved_models(spark, sf)
    parts = []
    for name, model in models.items():
        loaded = Detector.load(spark, base, name=name)
        got = loaded.score(rows, bounds="fitted").select("row_id", F.col("anomaly_score").alias("a"), F.col("anomaly_label").alias("x"))
        want = model.score(rows, bounds="fitted").select("row_id", F.col("anomaly_score").alias("b"), F.col("anomaly_label").alias("y"))
        same = (F.abs(F.col("a") - F.col("b")) < 1e-12) & (F.col("x") == F.col("y"))
        parts.append(got.join(want, "row_id").select("row_id", F.lit(name).alias("model_name"), same.alias("same_score")))
    return parts[0].unionByName(parts[1])


@query(
    """SELECT m AS model_name, v AS version, (SELECT count(*) FROM embeddings) AS training_samples, CAST(64 AS BIGINT) AS feature_count
    FROM (VALUES ('isolation_forest', 'v1'), ('one_class_svm', 'v1'), ('isolation_forest', 'v2')) t(m, v)"""
)
def model_versions_listed(spark, sf):
    """What the model store lists."""
    _, base, _ = _saved_models(spark, sf)
    return model_versions(spark, base).select("model_name", "version", "training_samples", "feature_count")


@query(
    f"""WITH {src.LOGS} SELECT 'levels' AS report, 'v2' AS version, level AS name, count(*) AS n FROM logs GROUP BY level
    UNION ALL SELECT 'services', 'v1', service, count(*) FROM logs GROUP BY service"""
)
def report_roundtrip(spark, sf):
    """Reports saved under versions; the newest of each is read."""
    path, logs = scratch_dir(spark, "reports"), src.logs(spark, sf)
    levels = logs.groupBy(F.col("level").alias("name")).agg(F.count("*").alias("n"))
    services = logs.groupBy(F.col("service").alias("name")).agg(F.count("*").alias("n"))
    store.save_report(levels.where("n > 1000000000"), path, "levels", "v1")
    store.save_report(levels, path, "levels", "v2")
    store.save_report(services, path, "services", "v1")
    return readers.latest_report(spark.read.parquet(path), "version", "report").select("report", "version", "name", "n")


@query(
    f"""WITH {src.LOGS} SELECT 'rule_v' || substring(service, 5) AS run_name, count(*) AS training_samples,
    round(avg(is_anomaly), 6) AS anomaly_share FROM logs GROUP BY service"""
)
def run_records(spark, sf):
    """A run recorded for every service, read back."""
    path = scratch_dir(spark, "runs")
    figures = src.logs(spark, sf).groupBy("service").agg(F.count("*").alias("n"), F.avg("is_anomaly").alias("share")).collect()
    for r in figures:  # six services
        store.record_run(spark, path, "rule", "v" + r["service"][4:], r["n"], 1, {"level": "ERROR"}, {"anomaly_share": r["share"]})
    rows = spark.read.schema(store.RUN_SCHEMA).parquet(path)
    return rows.select("run_name", "training_samples", F.round(F.col("metrics")["anomaly_share"], 6).alias("anomaly_share"))


@query(
    f"""WITH {src.LOGS} SELECT row_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", round(latency_ms, 6) AS latency_ms,
    score > 0.5 AS is_anomaly, round(score, 6) AS score FROM logs"""
)
def prediction_log(spark, sf):
    """Scored rows in the shape that monitoring reads."""
    scored = src.logs(spark, sf).drop("is_anomaly").withColumn("is_anomaly_detected", F.col("score") > 0.5)
    rows = monitor.prediction_log(scored, latency="latency_ms", score="score")
    return _timed(rows).select("row_id", "timestamp", F.round("latency_ms", 6).alias("latency_ms"), "is_anomaly", F.round("score", 6).alias("score"))


OWN_LINE = r"^## (\w+) (\w+) user_id=(\d+) (.*)$"


@query(
    f"""WITH {src.RAW_LINES} SELECT row_id, CASE WHEN regexp_matches(line, '{OWN_LINE}') THEN 'short' ELSE parse_method END AS parse_method,
    CASE WHEN regexp_matches(line, '{OWN_LINE}') THEN regexp_extract(line, '{OWN_LINE}', 2) ELSE service END AS service,
    CASE WHEN regexp_matches(line, '{OWN_LINE}') THEN regexp_extract(line, '{OWN_LINE}', 4) ELSE message END AS message
    FROM ({parsed_sql('raw_lines', 'row_id')}) JOIN raw_lines USING (row_id)"""
)
def own_patterns(spark, sf):
    """A line format of the caller, tried before the given ones."""
    own = LinePattern("short", OWN_LINE, {"level": 1, "service": 2, "message": 4})
    rows = parse(src.raw_lines(spark, sf), "line", [own, *DEFAULT_PATTERNS])
    return rows.select("row_id", "parse_method", "service", "message")


@query(
    f"""WITH {src.LOGS} SELECT row_id, regexp_replace(regexp_replace(message, 'user_id=[0-9]+', 'user_id=<USER>', 'g'), '[0-9]+ms', '<MS>', 'g') AS template
    FROM logs"""
)
def own_templates(spark, sf):
    """Placeholders of the caller instead of the given ones."""
    own = [(r"user_id=[0-9]+", "user_id=<USER>"), (r"[0-9]+ms", "<MS>")]
    return src.logs(spark, sf).select("row_id", template("message", own).alias("template"))


@query(
    f"""WITH {src.RAW_LINES}, p AS ({parsed_sql('raw_lines', 'row_id')})
    SELECT row_id, parse_method IN ('app_log', 'syslog', 'access_log') AS valid FROM p WHERE parse_method <> 'fallback'"""
)
def validate_syslog(spark, sf):
    """Lines whose times have no year are valid once a year is given."""
    parsed = parse(src.raw_lines(spark, sf), "line").where("parse_method <> 'fallback'")
    checked = validate.validate(parsed, default_year=2024)
    good = checked.valid.select("row_id", F.lit(True).alias("valid"))
    return good.unionByName(checked.quarantined.select("row_id", F.lit(False).alias("valid")))
