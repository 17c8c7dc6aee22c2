"""Canonical log table: columns, levels and limits shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine columns of a log table, in order.
LOG_COLUMNS = [
    "timestamp",
    "level",
    "service",
    "source_ip",
    "message",
    "raw_log",
    "log_hash",
    "parse_method",
    "is_anomaly",
]

# Stable row key.  Log tables have no order in Spark, so every operator that
# needs "first", "previous" or "the same row again" works on this column.
ROW_ID = "row_id"

LOG_SCHEMA = T.StructType(
    [T.StructField(ROW_ID, T.LongType(), False)]
    + [
        T.StructField(name, T.IntegerType() if name == "is_anomaly" else T.StringType(), True)
        for name in LOG_COLUMNS
    ]
)

# Severity codes; a level outside the table counts as INFO.
LEVEL_CODES = {
    "DEBUG": 0,
    "INFO": 1,
    "WARNING": 2,
    "WARN": 2,
    "ERROR": 3,
    "CRITICAL": 4,
}
DEFAULT_LEVEL_CODE = 1
VALID_LEVELS = sorted(LEVEL_CODES)

REQUIRED_COLUMNS = ["timestamp", "level", "service", "message"]

# Validation limits.
MAX_MESSAGE_LENGTH = 10_000
MIN_TIMESTAMP_YEAR = 2020
MAX_TIMESTAMP_YEAR = 9999
MAX_NULL_RATIO = 0.3

# Replacements for NULL or blank cells.
IMPUTE_DEFAULTS = {
    "level": "INFO",
    "service": "unknown",
    "source_ip": "0.0.0.0",
    "message": "",
}
