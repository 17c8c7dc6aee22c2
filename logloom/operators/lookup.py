"""Left-join a table of per-key figures back onto rows, safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.schema import ROW_ID

# A broadcast side never holds more rows or more text than this.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024


def _held_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value beyond a cell's fixed 16: texts, and all that arrays, maps and structs hold."""
    none = F.lit(0).cast("bigint")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("bigint"), none)
    if isinstance(kind, T.ArrayType):
        inner = lambda x: _held_bytes(x, kind.elementType) + 16
        return F.coalesce(F.aggregate(value, none, lambda a, x: a + inner(x)), none)
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return _held_bytes(F.map_entries(value), T.ArrayType(entry))
    if isinstance(kind, T.StructType):
        return sum((_held_bytes(value[f.name], f.dataType) + 16 for f in kind.fields), none)
    return none


def fits_broadcast(
    table: DataFrame, limit: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Count the rows of a small table and the bytes they hold, stopping past ``limit`` rows."""
    size = F.lit(16 * len(table.columns)).cast("bigint")
    for field in table.schema.fields:
        size = size + _held_bytes(F.col(f"`{field.name}`"), field.dataType)
    found = table.limit(limit + 1).agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return found["n"] <= limit and (found["b"] or 0) <= max_bytes


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: dict[str, object],
    weight: str = "n",
    row_id: str = ROW_ID,
    small: bool | None = None,
    parts: int = 1000,
) -> DataFrame:
    """Add ``values`` (column -> default) of ``table`` to every row.

    ``table`` has one row per key and the key's row count in ``weight``.

    * ``small=True``: the caller guarantees a bound; broadcast the table.
    * ``small=None``: count the table and broadcast it if it is small.
    * otherwise: keys holding at least 1/``parts`` of all rows are at most
      ``parts`` keys, and only those are broadcast.  Every other row goes
      through a shuffled join in which no key is hot.  Rows already answered,
      and rows with a NULL key, are spread by their row key instead of meeting
      in one task.
    """
    keys = list(keys)
    names = list(values)
    table = table.select(*keys, *names, *([weight] if weight not in names + keys else []))
    if small is None:
        small = fits_broadcast(table)
    if small:
        out = rows.join(F.broadcast(table.select(*keys, *names)), keys, "left")
        return out.withColumns({n: F.coalesce(n, F.lit(d)) for n, d in values.items()})

    total = table.agg(F.sum(weight).alias("t"))
    flagged = table.withColumn("_hot", F.col(weight) * parts >= total.scalar())
    hot = flagged.where("_hot").select(*keys, F.struct(*names).alias("_hot_value"))
    cold = flagged.where("NOT _hot").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.lit(0).cast("bigint").alias("_spread"),
        F.struct(*names).alias("_cold_value"),
    )
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    done = F.col("_hot_value").isNotNull() | no_key
    staged = rows.join(F.broadcast(hot), keys, "left").withColumns(
        {
            "_spread": F.when(done, F.xxhash64(row_id)).otherwise(F.lit(0).cast("bigint")),
            **{f"_k{i}": F.when(~done, F.col(k)) for i, k in enumerate(keys)},
        }
    )
    joined = staged.join(cold, [*[f"_k{i}" for i in range(len(keys))], "_spread"], "left")
    picked = {
        n: F.coalesce(F.col(f"_hot_value.{n}"), F.col(f"_cold_value.{n}"), F.lit(d))
        for n, d in values.items()
    }
    kept = [c for c in rows.columns if c not in picked]
    return joined.select(*kept, *[v.alias(n) for n, v in picked.items()])
