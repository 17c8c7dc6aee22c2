"""Message templates: variable parts replaced by placeholders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import col

# Fixed values: (pattern, replacement), applied in this order.
SUBSTITUTIONS: list[tuple[str, str]] = [
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "<IP>"),
    (
        r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",
        "<UUID>",
    ),
    (r"\b\d{10,13}\b", "<TIMESTAMP>"),
    (r"\b\d+\.\d+\b", "<FLOAT>"),
    (r"\b\d+\b", "<NUM>"),
    (r"\b[0-9a-fA-F]{6,}\b", "<HEX>"),
    (r"=\S+", "=<VALUE>"),
    (r"/\S+", "<PATH>"),
]


def template(c: Column | str, substitutions: Sequence[tuple[str, str]] | None = None) -> Column:
    out = col(c)
    for pattern, placeholder in SUBSTITUTIONS if substitutions is None else substitutions:
        out = F.regexp_replace(out, pattern, placeholder)
    return out
