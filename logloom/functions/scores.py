"""Derived score columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import col


def confidence(score: Column | str) -> Column:
    """Distance of a 0..1 score from 0.5, scaled to 0..1."""
    return F.abs(col(score) - 0.5) * 2


def is_anomaly(label: Column | str) -> Column:
    return col(label) == -1
