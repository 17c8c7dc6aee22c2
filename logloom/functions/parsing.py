"""Raw line to log record: a registry of line patterns with a generic fallback."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import col, extract_ip, sha256_hex
from logloom.schema import LOG_COLUMNS


@dataclass(frozen=True)
class LinePattern:
    """One line format.

    ``groups`` maps a field to its capture group.  A field named in ``groups``
    whose group took no part in the match is NULL; a field not named there
    gets the default (level INFO, service unknown, message = whole line).
    """

    name: str
    regex: str
    groups: dict[str, int] = field(default_factory=dict)
    extras: dict[str, int] = field(default_factory=dict)


# The line formats, tried in this order.
APP_LOG = LinePattern(
    "app_log",
    r"^(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}(?:\.\d+)?)\s+\[(\w+)\]\s+(?:(\S+?):\s+)?(.*)",
    {"timestamp": 1, "level": 2, "service": 3, "message": 4},
)
SYSLOG = LinePattern(
    "syslog",
    r"^(\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?)(?:\[(\d+)\])?:\s+(.*)",
    {"timestamp": 1, "service": 3, "message": 5},
    {"host": 2, "pid": 4},
)
ACCESS_LOG = LinePattern(
    "access_log",
    r"^(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\s+-\s+-\s+\[([^\]]+)\]\s+"
    r'"(\w+)\s+(\S+)\s+\S+"\s+(\d{3})\s+(\d+)',
    {"timestamp": 2},
    {"method": 3, "path": 4, "status": 5, "bytes": 6},
)
DEFAULT_PATTERNS: list[LinePattern] = [APP_LOG, SYSLOG, ACCESS_LOG]

# Fallback searches, first hit wins.
FALLBACK_TIMESTAMPS = [
    r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}(?:\.\d+)?",
    r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}",
    r"\w{3}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}",
]
FALLBACK_LEVELS = ["CRITICAL", "ERROR", "WARNING", "WARN", "INFO", "DEBUG"]

# Only \n ends a line inside a record, whatever other separators it holds.
_FLAGS = "(?d)"


def fallback_timestamp(c: Column | str) -> Column:
    hits = [F.nullif(F.regexp_extract(col(c), p, 0), F.lit("")) for p in FALLBACK_TIMESTAMPS]
    return F.coalesce(*hits, F.lit(""))


def fallback_level(c: Column | str) -> Column:
    """First known level contained anywhere in the upper-cased line."""
    upper = F.upper(col(c))
    out = None
    for level in FALLBACK_LEVELS:
        hit = upper.contains(level)
        out = F.when(hit, level) if out is None else out.when(hit, level)
    return out.otherwise("INFO")


def parse_lines(
    df: DataFrame,
    line: str = "line",
    patterns: Sequence[LinePattern] | None = None,
    extras: bool = False,
) -> DataFrame:
    """Parse a column of text lines into the canonical log columns.

    Input columns other than ``line`` are kept in front.  ``extras`` adds the
    further captures of the patterns (host, pid, method, path, status, bytes).
    A projection only: no shuffle, works on a stream as well.
    """
    patterns = DEFAULT_PATTERNS if patterns is None else list(patterns)
    text = F.col(line)
    method = None
    for p in patterns:
        hit = text.rlike(_FLAGS + p.regex)
        method = F.when(hit, p.name) if method is None else method.when(hit, p.name)
    method = F.lit("fallback") if method is None else method.otherwise("fallback")

    def capture(p: LinePattern, group: int) -> Column:
        return F.regexp_extract(text, _FLAGS + p.regex, group)

    def choose(fieldname: str, default: Column, fallback: Column) -> Column:
        out = None
        for p in patterns:
            if fieldname in p.groups:
                value = F.nullif(capture(p, p.groups[fieldname]), F.lit(""))
                if fieldname != "service":
                    value = F.coalesce(value, F.lit(""))
            else:
                value = default
            hit = F.col("parse_method") == p.name
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return fallback if out is None else out.otherwise(fallback)

    def extra(name: str) -> Column:
        out = F.lit(None).cast("string")
        for p in patterns:
            if name in p.extras:
                value = F.nullif(capture(p, p.extras[name]), F.lit(""))
                out = F.when(F.col("parse_method") == p.name, value).otherwise(out)
        return out

    fields = {
        "timestamp": choose("timestamp", F.lit(""), fallback_timestamp(text)),
        "level": F.upper(choose("level", F.lit("INFO"), fallback_level(text))),
        "service": choose("service", F.lit("unknown"), F.lit("unknown")),
        "source_ip": extract_ip(text),
        "message": choose("message", text, text),
        "raw_log": text,
        "log_hash": sha256_hex(text),
        "parse_method": F.col("parse_method"),
        "is_anomaly": F.lit(None).cast("int"),
    }
    kept = [c for c in df.columns if c != line]
    if extras:
        names = dict.fromkeys(n for p in patterns for n in p.extras)
        fields |= {n: extra(n) for n in names}
    # One generated struct per line: a later filter on a parsed field stays above
    # it, instead of being pushed down as a second copy of the pattern matching.
    record = F.struct(*[c.alias(n) for n, c in fields.items()])
    return df.withColumn("parse_method", method).select(*kept, F.inline(F.array(record)))
