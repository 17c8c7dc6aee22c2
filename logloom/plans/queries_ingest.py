"""Parsing, cleaning, validation and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions import parsing as ps
from logloom.functions import text as tx
from logloom.functions.scores import confidence
from logloom.functions.templates import SUBSTITUTIONS, template
from logloom.functions.timestamps import parse_timestamp
from logloom.operators import clean, dedup, validate
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.sources import readers
from logloom.sources.store import list_versions

TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def shown(c: str, alias: str | None = None):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(alias or c)


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


APP, SYS, ACC = (sql_text(p.regex) for p in ps.DEFAULT_PATTERNS)
FB = [sql_text(p) for p in ps.FALLBACK_TIMESTAMPS]
IP = sql_text(tx.IPV4)
ENDS = sql_text(f"^[{tx.SPACE}]+|[{tx.SPACE}]+$")
RUN = sql_text(f"[{tx.SPACE}]+")
BLANK = sql_text(f"^[{tx.SPACE}]*$")


def parsed_sql(source: str, keep: str) -> str:
    """SQL that parses column ``line`` of ``source``."""
    return f"""
  SELECT {keep}, m AS parse_method,
    CASE m WHEN 'app_log' THEN regexp_extract(line, {APP}, 1)
           WHEN 'syslog' THEN regexp_extract(line, {SYS}, 1)
           WHEN 'access_log' THEN regexp_extract(line, {ACC}, 2)
           ELSE coalesce(nullif(regexp_extract(line, {FB[0]}), ''),
                         nullif(regexp_extract(line, {FB[1]}), ''),
                         nullif(regexp_extract(line, {FB[2]}), ''), '') END AS "timestamp",
    upper(CASE WHEN m = 'app_log' THEN regexp_extract(line, {APP}, 2)
               WHEN m <> 'fallback' THEN 'INFO'
               WHEN contains(upper(line), 'CRITICAL') THEN 'CRITICAL'
               WHEN contains(upper(line), 'ERROR') THEN 'ERROR'
               WHEN contains(upper(line), 'WARNING') THEN 'WARNING'
               WHEN contains(upper(line), 'WARN') THEN 'WARN'
               WHEN contains(upper(line), 'INFO') THEN 'INFO'
               WHEN contains(upper(line), 'DEBUG') THEN 'DEBUG' ELSE 'INFO' END) AS level,
    CASE m WHEN 'app_log' THEN nullif(regexp_extract(line, {APP}, 3), '')
           WHEN 'syslog' THEN nullif(regexp_extract(line, {SYS}, 3), '')
           ELSE 'unknown' END AS service,
    regexp_extract(line, {IP}) AS source_ip,
    CASE m WHEN 'app_log' THEN regexp_extract(line, {APP}, 4)
           WHEN 'syslog' THEN regexp_extract(line, {SYS}, 5) ELSE line END AS message,
    line AS raw_log, sha256(line) AS log_hash
  FROM (SELECT *, CASE WHEN regexp_matches(line, {APP}) THEN 'app_log'
                       WHEN regexp_matches(line, {SYS}) THEN 'syslog'
                       WHEN regexp_matches(line, {ACC}) THEN 'access_log'
                       ELSE 'fallback' END AS m FROM {source})"""


# --- sources ---------------------------------------------------------------------


@query(f"WITH {src.RAW_LINES} {parsed_sql('raw_lines', 'row_id')}")
def parse_lines(spark, sf):
    return ps.parse_lines(src.raw_lines(spark, sf)).drop("is_anomaly")


@query(
    f"""WITH {src.RAW_LINES} SELECT row_id,
    CASE WHEN m = 2 THEN regexp_extract(line, {SYS}, 2) END AS host,
    CASE WHEN m = 2 THEN regexp_extract(line, {SYS}, 4) END AS pid,
    CASE WHEN m = 3 THEN regexp_extract(line, {ACC}, 3) END AS method,
    CASE WHEN m = 3 THEN regexp_extract(line, {ACC}, 4) END AS path,
    CASE WHEN m = 3 THEN regexp_extract(line, {ACC}, 5) END AS status,
    CASE WHEN m = 3 THEN regexp_extract(line, {ACC}, 6) END AS bytes
  FROM (SELECT *, CASE WHEN regexp_matches(line, {APP}) THEN 1 WHEN regexp_matches(line, {SYS})
    THEN 2 WHEN regexp_matches(line, {ACC}) THEN 3 ELSE 4 END AS m FROM raw_lines)"""
)
def parse_extras(spark, sf):
    rows = ps.parse_lines(src.raw_lines(spark, sf), extras=True)
    return rows.select("row_id", "host", "pid", "method", "path", "status", "bytes")


DOC_LINES = f"""
doc_lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, regexp_replace(cells[i], {ENDS}, '', 'g') AS line
  FROM (SELECT doc_id, cells, unnest(range(1, len(cells) + 1)) AS i FROM (
    SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), {ENDS}, '', 'g'), chr(10)) AS cells
    FROM documents)))
"""


@query(
    f"""WITH {DOC_LINES} SELECT * EXCLUDE (raw_log) FROM
    ({parsed_sql('doc_lines', 'doc_id, line_no')})"""
)
def ingest_text(spark, sf):
    rows = readers.ingest_text(src.table(spark, sf, "documents"), "text", "doc_id")
    return rows.drop("is_anomaly", "raw_log")


@query(
    f"""WITH {src.LOGS} SELECT row_id, {TS.format('"timestamp"')} AS "timestamp", level, service,
    source_ip, message, 'csv' AS parse_method, is_anomaly FROM logs"""
)
def ingest_csv(spark, sf):
    """CSV text cells with a free-form header."""
    logs = src.logs(spark, sf, heavy=True)
    quoted = F.concat(F.lit('"'), "message", F.lit('"'))
    text = F.concat_ws(
        ",",
        F.col("row_id").cast("string"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        F.lower("level"),
        "service",
        "source_ip",
        quoted,
        F.col("is_anomaly").cast("string"),
    )
    header = ["Row ID", " Timestamp", "LEVEL", "Service", "IP ", "Message", "Is Anomaly"]
    cells = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    rows = logs.select(F.from_csv(text, schema.simpleString()[7:-1].replace(":", " ")).alias("r"))
    named = rows.select("r.*").toDF(*readers.normalize_header(header))
    named = named.withColumn("row_id", F.col("row_id").cast("bigint"))
    return readers.normalize_csv(named, keep=["row_id"]).drop("raw_log", "log_hash")


def _json_lines(spark, sf):
    """JSON lines with alternative keys in turn; some lines are cut short, some no objects."""
    t = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("row_id") % 4

    def obj(**fields):
        parts = []
        for i, (k, v) in enumerate(fields.items()):
            parts += [F.lit(("{" if i == 0 else ", ") + f'"{k}": "'), v, F.lit('"')]
        return F.concat(*parts, F.lit("}"))

    c = F.col
    line = (
        F.when(
            c("row_id") % 97 == 0,
            F.concat(F.lit('{"timestamp": "'), t, F.lit('", "msg": "'), "message"),
        )
        .when(c("row_id") % 97 == 1, F.concat(F.lit("["), c("row_id").cast("string"), F.lit("]")))
        .when(
            kind == 0,
            obj(timestamp=t, level=F.lower("level"), service=c("service"),
                source_ip=c("source_ip"), message=c("message")),
        )
        .when(
            kind == 1,
            obj(timestamp=t, severity=c("level"), source=c("service"), ip=c("source_ip"),
                msg=c("message")),
        )
        .when(kind == 2, obj(message=c("message"), remote_addr=c("source_ip")))
        .otherwise(
            F.concat(
                F.lit('{"msg": "'), "message", F.lit('", "level": null, "severity": "'), "level",
                F.lit('", "is_anomaly": '), c("is_anomaly").cast("string"), F.lit("}"),
            )
        )
    )
    return src.logs(spark, sf, heavy=True).select("row_id", F.concat(F.lit(" "), line).alias("line"))


@query(
    f"""WITH {src.LOGS} SELECT row_id,
    CASE WHEN row_id % 4 < 2 THEN {TS.format('"timestamp"')} ELSE '' END AS "timestamp",
    CASE WHEN row_id % 4 = 2 THEN 'INFO' ELSE level END AS level,
    CASE WHEN row_id % 4 < 2 THEN service ELSE 'unknown' END AS service,
    CASE WHEN row_id % 4 < 3 THEN source_ip ELSE '' END AS source_ip,
    message, 'json' AS parse_method,
    CASE WHEN row_id % 4 = 3 THEN is_anomaly END AS is_anomaly
  FROM logs WHERE row_id % 97 > 1"""
)
def ingest_json_alias(spark, sf):
    good, _ = readers.ingest_json_lines(_json_lines(spark, sf), "line", keep=["row_id"])
    return good.drop("raw_log", "log_hash")


@query(
    f"""WITH {src.LOGS} SELECT 'json' AS kind, count(*) AS n FROM logs WHERE row_id % 97 > 1
    UNION ALL SELECT 'parse_error', count(*) FROM logs WHERE row_id % 97 <= 1"""
)
def parse_error_stats(spark, sf):
    good, bad = readers.ingest_json_lines(_json_lines(spark, sf), "line", keep=["row_id"])
    return readers.ingest_stats(good, bad)


@query(
    f"""WITH {src.RAW_LINES} SELECT parse_method AS kind, count(*) AS n FROM
    ({parsed_sql('raw_lines', 'row_id')}) GROUP BY 1"""
)
def parse_stats(spark, sf):
    return readers.ingest_stats(ps.parse_lines(src.raw_lines(spark, sf)))


@query(
    f"""WITH {src.RAW_LINES} SELECT parse_method, count(*) AS n, count(is_anomaly) AS labelled FROM (
    SELECT parse_method, NULL AS is_anomaly FROM ({parsed_sql('raw_lines', 'row_id')})
    UNION ALL SELECT 'table', is_anomaly FROM logs) GROUP BY 1"""
)
def union_batches(spark, sf):
    batches = [
        ps.parse_lines(src.raw_lines(spark, sf)).drop("is_anomaly"),
        src.logs(spark, sf).select(
            "row_id", "level", "service", "message", F.lit("table").alias("parse_method"), "is_anomaly"
        ),
    ]
    rows = readers.union_batches(batches)
    return rows.groupBy("parse_method").agg(
        F.count("*").alias("n"), F.count("is_anomaly").alias("labelled")
    )


DAILY = """daily AS (SELECT service AS name, strftime("timestamp", 'v%Y%m%d') AS version,
    count(*) AS n, sum(is_anomaly) AS anomalies FROM logs GROUP BY 1, 2)"""


def _daily(spark, sf):
    return (
        src.logs(spark, sf)
        .groupBy(
            F.col("service").alias("name"),
            F.concat(F.lit("v"), F.date_format("timestamp", "yyyyMMdd")).alias("version"),
        )
        .agg(F.count("*").alias("n"), F.sum("is_anomaly").alias("anomalies"))
    )


@query(
    f"""WITH {src.LOGS}, {DAILY} SELECT name, version, n, CAST(anomalies AS BIGINT) AS anomalies
    FROM daily QUALIFY version = max(version) OVER (PARTITION BY name)"""
)
def latest_report(spark, sf):
    rows = readers.latest_report(_daily(spark, sf))
    return rows.select("name", "version", "n", "anomalies")


@query(
    f"""WITH {src.LOGS}, {DAILY} SELECT name AS dataset, version, n AS n_rows,
    version AS created_at FROM daily WHERE name = 'svc-2' ORDER BY created_at DESC"""
)
def feature_versions(spark, sf):
    meta = _daily(spark, sf).select(
        F.col("name").alias("dataset"),
        "version",
        F.col("n").alias("n_rows"),
        F.col("version").alias("created_at"),
    )
    return list_versions(meta, "svc-2")


# --- scalars ---------------------------------------------------------------------


@query(
    f"""WITH {DOC_LINES} SELECT doc_id, line_no,
    coalesce(nullif(regexp_extract(line, {FB[0]}), ''), nullif(regexp_extract(line, {FB[1]}), ''),
      nullif(regexp_extract(line, {FB[2]}), ''), '') AS found_timestamp,
    CASE WHEN contains(upper(line), 'CRITICAL') THEN 'CRITICAL'
         WHEN contains(upper(line), 'ERROR') THEN 'ERROR'
         WHEN contains(upper(line), 'WARNING') THEN 'WARNING'
         WHEN contains(upper(line), 'WARN') THEN 'WARN'
         WHEN contains(upper(line), 'INFO') THEN 'INFO'
         WHEN contains(upper(line), 'DEBUG') THEN 'DEBUG' ELSE 'INFO' END AS found_level
    FROM doc_lines"""
)
def fallback_fields(spark, sf):
    lines = readers.explode_text(src.table(spark, sf, "documents"), "text", "doc_id")
    return lines.select(
        "doc_id",
        "line_no",
        ps.fallback_timestamp("line").alias("found_timestamp"),
        ps.fallback_level("line").alias("found_level"),
    )


@query(f"SELECT doc_id, regexp_extract(coalesce(text, ''), {IP}) AS ip FROM documents")
def extract_ip(spark, sf):
    return src.table(spark, sf, "documents").select("doc_id", tx.extract_ip("text").alias("ip"))


@query("SELECT doc_id, sha256(text) AS log_hash FROM documents")
def log_hash(spark, sf):
    return src.table(spark, sf, "documents").select("doc_id", tx.sha256_hex("text").alias("log_hash"))


SHAPES = [
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "%Y-%m-%dT%H:%M:%S.%f"),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "%Y-%m-%dT%H:%M:%S.%fZ"),
    ("dd/MMM/yyyy:HH:mm:ss '+0130'", "%d/%b/%Y:%H:%M:%S +0130"),
    ("MMM dd HH:mm:ss", "%b %d %H:%M:%S"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", "%Y-%m-%d %H:%M:%S.%f"),
    ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S"),
    ("HH:mm yyyy", "%H:%M %Y"),
]


@query(
    f"""WITH {src.LOGS}, texts AS (SELECT row_id, ' ' || CASE row_id % 10 {' '.join(
        f"WHEN {i} THEN strftime(\"timestamp\", '{d}')" for i, (_, d) in enumerate(SHAPES))} END
      || ' ' AS t FROM logs)
    SELECT row_id, strftime(coalesce(
      try_strptime(trim(t), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(t), '%Y-%m-%dT%H:%M:%S'),
      try_strptime(trim(t), '%Y-%m-%dT%H:%M:%S.%f'), try_strptime(trim(t), '%Y-%m-%dT%H:%M:%SZ'),
      try_strptime(trim(t), '%Y-%m-%dT%H:%M:%S.%fZ'),
      try_strptime(trim(t), '%d/%b/%Y:%H:%M:%S +0130') - INTERVAL 90 MINUTE,
      try_strptime('1900 ' || trim(t), '%Y %b %d %H:%M:%S'),
      try_strptime(trim(t), '%Y-%m-%d %H:%M:%S.%f'), try_strptime(trim(t), '%m/%d/%Y %H:%M:%S')),
      '%Y-%m-%d %H:%M:%S.%f') AS parsed FROM texts"""
)
def timestamp_formats(spark, sf):
    shape = F.col("row_id") % 10
    text = None
    for i, (fmt, _) in enumerate(SHAPES):
        shown_as = F.date_format("timestamp", fmt)
        text = F.when(shape == i, shown_as) if text is None else text.when(shape == i, shown_as)
    rows = src.logs(spark, sf, heavy=True).select("row_id", F.concat(F.lit(" "), text, F.lit(" ")).alias("t"))
    parsed = F.date_format(parse_timestamp("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return rows.select("row_id", parsed.alias("parsed"))


ANSI_SQL = sql_text(tx.ANSI)


@query(
    f"""WITH {src.LOGS} SELECT row_id,
    regexp_replace(chr(27) || '[31m' || message || chr(27) || '[0;1m', {ANSI_SQL}, '', 'g') AS message
    FROM logs"""
)
def strip_ansi(spark, sf):
    esc = F.char(F.lit(27))
    colored = F.concat(esc, F.lit("[31m"), "message", esc, F.lit("[0;1m"))
    return src.logs(spark, sf).select("row_id", tx.strip_ansi(colored).alias("message"))


CLEAN_SQL = f"trim(regexp_replace(regexp_replace(text, {ANSI_SQL}, '', 'g'), {RUN}, ' ', 'g'))"


@query(f"SELECT doc_id, {CLEAN_SQL} AS message, lower({CLEAN_SQL}) AS lowered FROM documents")
def clean_message(spark, sf):
    return src.table(spark, sf, "documents").select(
        "doc_id",
        tx.clean_message("text").alias("message"),
        tx.clean_message("text", lowercase=True).alias("lowered"),
    )


def imputed_sql(c: str, default: str) -> str:
    return f"CASE WHEN {c} IS NULL OR regexp_matches({c}, {BLANK}) THEN '{default}' ELSE {c} END AS {c}"


@query(
    f"""WITH {src.DIRTY} SELECT row_id, {imputed_sql('level', 'INFO')},
    {imputed_sql('service', 'unknown')}, {imputed_sql('source_ip', '0.0.0.0')},
    {imputed_sql('message', '')} FROM dirty"""
)
def impute(spark, sf):
    rows = clean.impute(src.dirty_logs(spark, sf))
    return rows.select("row_id", "level", "service", "source_ip", "message")


LEVEL_CODE = """CAST(CASE upper(level) WHEN 'DEBUG' THEN 0 WHEN 'INFO' THEN 1 WHEN 'WARNING' THEN 2
    WHEN 'WARN' THEN 2 WHEN 'ERROR' THEN 3 WHEN 'CRITICAL' THEN 4 ELSE 1 END AS INTEGER)"""
CALENDAR = """CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
    CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week"""
HAS_IP = f"""CAST(source_ip IS NOT NULL AND NOT regexp_matches(source_ip, {BLANK})
    AND source_ip <> '0.0.0.0' AS INTEGER) AS has_ip"""


@query(
    f"""WITH {src.LOGS} SELECT row_id, CAST(length(message) AS INTEGER) AS message_length,
    {LEVEL_CODE} AS level_numeric, {CALENDAR},
    CAST(hour("timestamp") BETWEEN 9 AND 17 AS INTEGER) AS is_business_hours, {HAS_IP} FROM logs"""
)
def derived_columns(spark, sf):
    return clean.derive(src.logs(spark, sf)).select(
        "row_id",
        "message_length",
        "level_numeric",
        "hour_of_day",
        "day_of_week",
        "is_business_hours",
        "has_ip",
    )


def nested_sql(column: str, steps) -> str:
    out = column
    for pattern, replacement in steps:
        out = f"regexp_replace({out}, {sql_text(pattern)}, '{replacement}', 'g')"
    return out


@query(f"SELECT doc_id, {nested_sql('text', tx.PII_PATTERNS)} AS masked FROM documents")
def mask_pii(spark, sf):
    return src.table(spark, sf, "documents").select("doc_id", tx.mask_pii("text").alias("masked"))


TEMPLATE_SQL = nested_sql("message", SUBSTITUTIONS)


@query(
    f"""WITH {src.LOGS} SELECT row_id, {TEMPLATE_SQL} AS template FROM logs
    UNION ALL SELECT -1 - doc_id, {nested_sql('text', SUBSTITUTIONS)} FROM documents"""
)
def message_template(spark, sf):
    logs = src.logs(spark, sf, heavy=True).select("row_id", template("message").alias("template"))
    docs = src.table(spark, sf, "documents").select(
        (F.lit(-1) - F.col("doc_id")).alias("row_id"), template("text").alias("template")
    )
    return logs.unionByName(docs)


WORDS = sql_text(f"[^{tx.SPACE}]+")
SPECIAL = sql_text(rf"[^\p{{L}}\p{{N}}{tx.SPACE}]")
UPPER = sql_text(f"[{tx.UPPER}]")


def text_stats_sql(c: str) -> str:
    return f"""CAST(len(regexp_extract_all({c}, {WORDS})) AS INTEGER) AS word_count,
    round(len(regexp_extract_all({c}, {SPECIAL})) / greatest(length({c}), 1), 6) AS special_char_ratio,
    round(len(regexp_extract_all({c}, {UPPER})) / greatest(length({c}), 1), 6) AS uppercase_ratio"""


@query(f"SELECT doc_id, CAST(length(text) AS INTEGER) AS message_length, {text_stats_sql('text')} FROM documents")
def text_stats(spark, sf):
    return src.table(spark, sf, "documents").select(
        "doc_id",
        F.length("text").alias("message_length"),
        tx.word_count("text").alias("word_count"),
        F.round(tx.special_char_ratio("text"), 6).alias("special_char_ratio"),
        F.round(tx.uppercase_ratio("text"), 6).alias("uppercase_ratio"),
    )


@query(
    f"""WITH {src.LOGS} SELECT row_id,
    round(CASE WHEN is_anomaly = 0 THEN 0.0 ELSE latency_ms / is_anomaly END, 6) AS ratio FROM logs"""
)
def safe_divide(spark, sf):
    return src.logs(spark, sf).select(
        "row_id", F.round(tx.safe_divide("latency_ms", "is_anomaly"), 6).alias("ratio")
    )


@query(
    """SELECT event_id AS row_id, CAST(props->>'k' AS BIGINT) AS "entry.props.k",
    event_type AS "entry.kind" FROM events"""
)
def flatten_props(spark, sf):
    events = src.table(spark, sf, "events")
    nested = events.select(
        F.col("event_id").alias("row_id"),
        F.struct(
            F.from_json("props", "k bigint").alias("props"), F.col("event_type").alias("kind")
        ).alias("entry"),
    )
    return tx.flatten_columns(nested)


@query(
    """SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 497) || '...'
    ELSE text END AS shown FROM documents"""
)
def truncate_text(spark, sf):
    return src.table(spark, sf, "documents").select("doc_id", tx.truncate("text", 500).alias("shown"))


@query(f"WITH {src.LOGS} SELECT row_id, round(abs(score - 0.5) * 2, 6) AS confidence FROM logs")
def score_confidence(spark, sf):
    return src.logs(spark, sf).select("row_id", F.round(confidence("score"), 6).alias("confidence"))


# --- validation ------------------------------------------------------------------

CHECKED = src.DIRTY + f""",
flags AS (
  SELECT *, ("timestamp" IS NOT NULL AND NOT regexp_matches("timestamp", {BLANK})
      AND message IS NOT NULL AND NOT regexp_matches(message, {BLANK})) AS ok_null,
    coalesce(upper(level) IN ('DEBUG','INFO','WARNING','WARN','ERROR','CRITICAL'), false) AS ok_level,
    coalesce(year(try_strptime(trim("timestamp"), '%Y-%m-%d %H:%M:%S')) >= 2020, false) AS ok_ts,
    coalesce(length(message) <= 10000, true) AS ok_len
  FROM dirty)
"""
REPAIRED = "CASE WHEN ok_level THEN level ELSE 'INFO' END AS level"


@query(
    f"""WITH {CHECKED} SELECT row_id, "timestamp", {REPAIRED}, service, message FROM flags
    WHERE ok_null AND ok_ts AND ok_len"""
)
def validate_valid(spark, sf):
    rows = validate.validate(src.dirty_logs(spark, sf)).valid
    return rows.select("row_id", "timestamp", "level", "service", "message")


@query(
    f"""WITH {CHECKED} SELECT row_id, "timestamp", {REPAIRED}, concat_ws(',',
    CASE WHEN NOT ok_null THEN 'null_check' END, CASE WHEN NOT ok_level THEN 'log_level' END,
    CASE WHEN NOT ok_ts THEN 'timestamp' END, CASE WHEN NOT ok_len THEN 'message_length' END) AS reasons
    FROM flags WHERE NOT (ok_null AND ok_ts AND ok_len)"""
)
def validate_quarantined(spark, sf):
    rows = validate.validate(src.dirty_logs(spark, sf)).quarantined
    return rows.select("row_id", "timestamp", "level", F.concat_ws(",", "reasons").alias("reasons"))


@query(
    f"""WITH {CHECKED}, totals AS (SELECT count(*) AS n, count_if(NOT ok_null) AS a,
      count_if(NOT ok_level) AS b, count_if(NOT ok_ts) AS c, count_if(NOT ok_len) AS d,
      count_if(NOT (ok_null AND ok_ts AND ok_len)) AS e FROM flags),
    cells AS (SELECT 'schema' AS "check", n, 0 AS f FROM totals
      UNION ALL SELECT 'null_check', n, a FROM totals UNION ALL SELECT 'log_level', n, b FROM totals
      UNION ALL SELECT 'timestamp', n, c FROM totals
      UNION ALL SELECT 'message_length', n, d FROM totals
      UNION ALL SELECT 'overall', n, e FROM totals)
    SELECT "check", CAST(n - f AS BIGINT) AS passed, CAST(f AS BIGINT) AS failed,
      round((n - f) / n, 6) AS pass_rate FROM cells"""
)
def quality_report(spark, sf):
    rows = validate.validate(src.dirty_logs(spark, sf)).report
    return rows.withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    f"""WITH {src.DIRTY} SELECT 'schema' AS "check", CAST(0 AS BIGINT) AS passed, count(*) AS failed
    FROM dirty UNION ALL SELECT 'overall', CAST(0 AS BIGINT), count(*) FROM dirty"""
)
def schema_check(spark, sf):
    """A table without a required column fails as a whole."""
    rows = src.dirty_logs(spark, sf).drop("service")
    report = validate.validate(rows).report
    return report.where("check IN ('schema', 'overall')").select("check", "passed", "failed")


@query(
    f"""WITH {src.DIRTY} SELECT row_id, coalesce("timestamp", '2024-02-01 00:00:00') AS "timestamp",
    coalesce(level, 'INFO') AS level, coalesce(service, 'unknown') AS service,
    coalesce(source_ip, '') AS source_ip, message FROM dirty
    WHERE length(message) BETWEEN 1 AND 10000"""
)
def request_limits(spark, sf):
    rows = validate.accept_requests(
        src.dirty_logs(spark, sf), now=F.lit("2024-02-01 00:00:00")
    )
    return rows.drop("is_anomaly")


@query(
    f"""WITH {src.LOGS} SELECT row_id, {TS.format('"timestamp"')} AS "timestamp", service FROM logs
    WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
    AND service = 'svc-3'"""
)
def date_service_filter(spark, sf):
    rows = validate.date_range(src.logs(spark, sf), "2024-01-10", "2024-01-20", "svc-3")
    return rows.select("row_id", shown("timestamp"), "service")


@query(
    f"""WITH {src.DIRTY}, c AS (SELECT count(*) AS n, count(*) - count("timestamp") AS a,
      count(*) - count(level) AS b, count(*) - count(service) AS s, count(*) - count(message) AS m FROM dirty)
    SELECT column_name, nulls, round(nulls / n, 6) AS null_ratio, nulls / n <= 0.3 AS within_limit FROM (
      SELECT 'timestamp' AS column_name, n, a AS nulls FROM c UNION ALL SELECT 'level', n, b FROM c
      UNION ALL SELECT 'service', n, s FROM c UNION ALL SELECT 'message', n, m FROM c)"""
)
def null_ratio_gate(spark, sf):
    rows = validate.null_ratios(
        src.dirty_logs(spark, sf), ["timestamp", "level", "service", "message"]
    )
    return rows.withColumn("null_ratio", F.round("null_ratio", 6))


# --- de-duplication --------------------------------------------------------------


@query(
    f"""WITH {src.DOCUMENT_LOGS} SELECT row_id, {TS.format('"timestamp"')} AS "timestamp", log_hash
    FROM document_logs QUALIFY row_number() OVER (PARTITION BY log_hash ORDER BY "timestamp", row_id) = 1"""
)
def dedup_hash(spark, sf):
    rows = dedup.keep_first(src.document_logs(spark, sf), ["log_hash"])
    return rows.select("row_id", shown("timestamp"), "log_hash")


@query(
    f"""WITH {src.LOGS} SELECT row_id, service, message FROM logs
    QUALIFY row_number() OVER (PARTITION BY service, message ORDER BY "timestamp", row_id) = 1"""
)
def dedup_key(spark, sf):
    rows = dedup.keep_first(src.logs(spark, sf), ["service", "message"])
    return rows.select("row_id", "service", "message")


@query(
    f"""WITH {src.DOCUMENT_LOGS}, a AS (SELECT * FROM document_logs QUALIFY
      row_number() OVER (PARTITION BY log_hash ORDER BY "timestamp", row_id) = 1)
    SELECT row_id FROM a
    QUALIFY row_number() OVER (PARTITION BY service, message ORDER BY "timestamp", row_id) = 1"""
)
def dedup_both(spark, sf):
    return dedup.deduplicate(src.document_logs(spark, sf)).select("row_id")


@query(
    f"""WITH {src.LOGS} SELECT row_id FROM (SELECT row_id, "timestamp",
      lag("timestamp") OVER (PARTITION BY service, level ORDER BY "timestamp", row_id) AS prev FROM logs)
    WHERE prev IS NULL OR "timestamp" - prev >= INTERVAL 45 MINUTE"""
)
def dedup_window(spark, sf):
    """Repeats of (service, level) within 45 minutes."""
    rows = src.logs(spark, sf).withColumn("message", F.col("level"))
    return dedup.deduplicate(rows, hash_col=None, window_minutes=45).select("row_id")


@query(
    f"""WITH {src.LOGS} SELECT CAST(count(*) - count(DISTINCT (service, message)) AS BIGINT)
    AS duplicates_removed FROM logs"""
)
def dedup_removed(spark, sf):
    return dedup.removed_count(src.logs(spark, sf), ["service", "message"])
