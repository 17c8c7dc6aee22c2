"""Keep-first de-duplication.

"First" is the smallest (timestamp, row_id).  The pair is packed into one
DECIMAL so that a plain ``min`` finds it: that is a hash aggregate with
map-side combine, so a key held by a third of all rows reaches the reducer as
one value per map task.  The wide rows are then picked by ``row_id``, which is
unique, so no task of that join is larger than the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.schema import ROW_ID

_RADIX = Decimal(2 * 10**19)  # above the number of BIGINT values
_SHIFT = Decimal(2**63)  # makes every row key non-negative
_NO_TIME = 4 * 10**18  # later than any time, small enough for 38 digits


def _packed(ts: str, row_id: str) -> Column:
    micros = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(_NO_TIME))
    return (
        micros.cast("decimal(19,0)") * F.lit(_RADIX)
        + (F.col(row_id).cast("decimal(20,0)") + F.lit(_SHIFT))
    ).cast("decimal(38,0)")


def _row_id_of(packed: Column) -> Column:
    return (F.pmod(packed, F.lit(_RADIX).cast("decimal(38,0)")) - F.lit(_SHIFT)).cast("bigint")


def _micros_of(packed: Column) -> Column:
    return F.floor(packed / F.lit(_RADIX)).cast("bigint")


def first_row_ids(
    df: DataFrame, keys: Sequence[str | Column], ts: str = "timestamp", row_id: str = ROW_ID
) -> DataFrame:
    """One ``row_id`` per key: the row that comes first.  NULL keys are one key."""
    first = df.groupBy(*keys).agg(F.min(_packed(ts, row_id)).alias("_first"))
    return first.select(_row_id_of(F.col("_first")).alias(row_id))


def message_key(service: str = "service", message: str = "message") -> list[Column]:
    """(service, message) as two integers drawn from one SHA-256, NULL kept apart from ''.

    128 bits name the pair, however long the message, and integers stay inside
    a hash aggregate.  Hashing the digest, not the text, leaves nothing for a
    crafted message to aim at.
    """
    part = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in (service, message)]
    digest = F.sha2(F.concat_ws("\x00", *part), 256)
    return [F.xxhash64(F.lit(n), digest).alias(f"_key{n}") for n in (1, 2)]


def keep_first(
    df: DataFrame, keys: Sequence[str], ts: str = "timestamp", row_id: str = ROW_ID
) -> DataFrame:
    narrow = df.select(*{*keys, ts, row_id})
    return df.join(first_row_ids(narrow, list(keys), ts, row_id), row_id, "left_semi")


def window_survivors(
    narrow: DataFrame,
    minutes: int,
    keys: Sequence[str] = ("_key1", "_key2"),
    ts: str = "timestamp",
    row_id: str = ROW_ID,
) -> DataFrame:
    """Row ids left when a row repeats its key within ``minutes`` of the row before.

    Time is cut into buckets of that same width.  Inside a bucket every row but
    the first is close to its predecessor and goes; the first stays unless the
    bucket just before ends less than ``minutes`` earlier.  So one first and one
    last value per (key, bucket) decide everything, and no task ever holds all
    rows of a key.  Rows without a time are kept.
    """
    width = minutes * 60_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    timed = narrow.where(F.col(ts).isNotNull()).withColumn(
        "_bucket", F.floor(micros / F.lit(width)).cast("bigint")
    )
    spans = timed.groupBy(*keys, "_bucket").agg(
        F.min(_packed(ts, row_id)).alias("_first"),
        F.min(micros).alias("_start"),
        F.max(micros).alias("_end"),
    )
    before = spans.select(
        *keys, (F.col("_bucket") + 1).alias("_bucket"), F.col("_end").alias("_prev_end")
    )
    kept = (
        spans.join(before, [*keys, "_bucket"], "left")
        .where(F.col("_prev_end").isNull() | (F.col("_start") - F.col("_prev_end") >= width))
        .select(_row_id_of(F.col("_first")).alias(row_id))
    )
    untimed = narrow.where(F.col(ts).isNull()).select(row_id)
    return kept.unionByName(untimed)


def deduplicate(
    df: DataFrame,
    hash_col: str | None = "log_hash",
    window_minutes: int | None = None,
    ts: str = "timestamp",
    row_id: str = ROW_ID,
) -> DataFrame:
    """First row per hash, then first row per (service, message).

    With ``window_minutes`` the second phase drops a repeat only when it
    follows its predecessor within that time.  The first phase hands each
    winner's key on to the second, so the keys are computed in one narrow pass,
    and the wide rows are joined once.
    """
    keys = ["_key1", "_key2"]
    narrow = df.select(row_id, ts, *message_key(), *([hash_col] if hash_col in df.columns else []))
    if hash_col in df.columns:
        packed = _packed(ts, row_id)
        first = narrow.groupBy(hash_col).agg(
            F.min(packed).alias("_first"), *[F.min_by(k, packed).alias(k) for k in keys]
        )
        if window_minutes is None:
            kept = first.groupBy(*keys).agg(F.min("_first").alias("_first"))
            kept = kept.select(_row_id_of(F.col("_first")).alias(row_id))
        else:
            micros = _micros_of(F.col("_first"))
            rows = first.select(
                *keys,
                _row_id_of(F.col("_first")).alias(row_id),
                F.when(micros < _NO_TIME, F.timestamp_micros(micros)).alias(ts),
            )
            kept = window_survivors(rows, window_minutes, keys, ts, row_id)
    elif window_minutes is None:
        kept = first_row_ids(narrow, keys, ts, row_id)
    else:
        kept = window_survivors(narrow, window_minutes, keys, ts, row_id)
    return df.join(kept, row_id, "left_semi")


def removed_count(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """How many rows keep-first over ``keys`` removes, without doing it."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates_removed")
    )
