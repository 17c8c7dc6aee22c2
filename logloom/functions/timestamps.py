"""Timestamp parsing and calendar fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import col, collapse_space, strip

# The accepted shapes.  A shape test picks the branch, so only
# text that fits a format is handed to its parser.
_PLAIN = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"(?: \d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?|T\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?Z?)$"
)
_ACCESS = r"^\d{1,2}/[A-Za-z]{3}/\d{4}:\d{1,2}:\d{1,2}:\d{1,2} [+-]\d{4}$"
_SYSLOG = r"^[A-Za-z]{3} \d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
_US = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"


def _whole(shape: str) -> str:
    """The shape without a line end behind it, which ``$`` lets pass."""
    return shape.removesuffix("$") + r"\z"


def parse_timestamp(
    c: Column | str,
    formats: Sequence[str] | None = None,
    default_year: int = 1900,
) -> Column:
    """Text to TIMESTAMP, NULL when no format fits.

    Without ``formats`` the built-in shapes are tried: ISO date and time with
    a space or ``T``, optional fraction, optional ``Z``; access-log time with
    offset; syslog time, which has no year and gets ``default_year``;
    ``month/day/year``.  ``formats`` replaces them by Spark datetime patterns,
    tried in order.

    Text that needs no trimming is parsed as it is, after a pattern test for each
    of the common shapes; only the rest is squeezed and matched again.
    """
    raw = col(c)
    if formats is not None:
        return F.coalesce(*[F.try_to_timestamp(strip(raw), F.lit(f)) for f in formats])

    def syslog(text: Column) -> Column:
        return F.try_to_timestamp(F.concat(F.lit(f"{default_year:04d} "), text), F.lit("yyyy MMM d H:m:s"))

    def access(text: Column) -> Column:
        return F.try_to_timestamp(text, F.lit("d/MMM/yyyy:H:m:s xx"))

    text = collapse_space(raw)
    other = (
        F.when(text.rlike(_PLAIN), text.try_cast("timestamp"))
        .when(text.rlike(_SYSLOG), syslog(text))
        .when(text.rlike(_ACCESS), access(text))
        .when(text.rlike(_US), F.try_to_timestamp(text, F.lit("M/d/yyyy H:m:s")))
    )
    return (
        F.when(raw.rlike(_PLAIN), raw.try_cast("timestamp"))
        .when(raw.rlike(_whole(_SYSLOG)), syslog(raw))
        .when(raw.rlike(_whole(_ACCESS)), access(raw))
        .otherwise(other)
    )


def to_timestamp_any(c: Column | str, dtype: str, **kwargs) -> Column:
    """TIMESTAMP from a column that is text or already a time."""
    return parse_timestamp(c, **kwargs) if dtype == "string" else col(c).cast("timestamp")


def hour_of_day(c: Column | str) -> Column:
    return F.hour(col(c))


def day_of_week(c: Column | str) -> Column:
    """Monday is 0."""
    return F.weekday(col(c))


def is_business_hours(c: Column | str) -> Column:
    """1 for hours 9 to 17 inclusive."""
    return F.coalesce(F.hour(col(c)).between(9, 17), F.lit(False)).cast("int")


def window_start(c: Column | str, minutes: int) -> Column:
    """Start of the tumbling window, as whole minutes counted from the epoch."""
    minute = F.floor(F.unix_micros(col(c)) / F.lit(60_000_000))
    return (minute - F.pmod(minute, F.lit(minutes))).cast("bigint")
