"""Line de-duplication through a sharded minimal perfect hash.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased.  Keys found in at least ``min_docs`` documents lose all their lines.

1. Every document gives its distinct key hashes (128 bits).  A hash aggregate
   with map-side combine counts documents per hash, so a line that a third of
   all documents share reaches its reducer as one row per map task.
2. Hashes go to shards of about ``SHARD_KEYS``.  Each shard becomes one row:
   a minimal perfect hash, and under its numbers an array of fingerprints and
   an array of document counts.
3. Documents probe the arrays: their hashes travel to the shard, never the lines.
   A shard with more probes than ``PROBES`` (it holds a hot line) is copied, and the probes
   of its documents are split over the copies.
4. Hashes over the limit return to their document, which drops those lines.

Defined results: null and empty texts are one empty line, which stays (keys
need ``min_chars`` code points, at least 1); every row counts as a document, also a
repeated one; null ids are an id like others; an empty table gives an empty
table; other columns stay as they are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import materialize, prepare
from logloom.llm.linehash import PerfectHash

MIN_DOCS, MIN_CHARS = 10, 1
SHARD_KEYS, PROBES = 50_000, 500_000


def _key_hashes(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """Hash of the key of each line; None where the key is too short."""
    out = []
    for line in (text or b"").split(b"\n"):
        key = line.strip().lower()
        short = len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars)
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


def _hashes(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, joined = [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            keys = {h for h in _key_hashes(text, min_chars) if h}
            rows.append(len(keys))
            joined.extend(keys)
        halves = np.frombuffer(b"".join(joined), dtype="<i8").reshape(-1, 2)
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(rows)), rows)))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1]))],
            names=["key", "low", "high"],
        )


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _build(shard: pa.Table) -> pa.Table:
    """One row: the perfect hash of a shard and its arrays."""
    low, high = _unsigned(shard["low"]), _unsigned(shard["high"])
    numbers = PerfectHash.build(low, high)
    at = numbers.index(low, high)
    prints = np.zeros(len(low), dtype=np.uint64)
    counts = np.zeros(len(low), dtype=np.uint32)
    prints[at] = low ^ (high << np.uint64(1))
    counts[at] = np.minimum(shard["docs"].to_numpy(), 2**32 - 1)
    row = {"shard": shard["shard"][0].as_py(), "prints": prints.tobytes(), "counts": counts.tobytes()}
    row["copies"] = int(-(-int(shard["docs"].to_numpy().sum()) // PROBES))
    return pa.Table.from_pylist([row | numbers.dump()], schema=BUILT)


BUILT = pa.schema(
    [("shard", pa.int64()), ("copies", pa.int32())] + [(n, pa.binary()) for n in ("sizes", "bits", "rest", "prints", "counts")]
)
BUILT_DDL = "shard bigint, copies int, sizes binary, bits binary, rest binary, prints binary, counts binary"


def _probe(arrays: pa.Table, probes: pa.Table, min_docs: int) -> pa.Table:
    """The probes whose line is in at least ``min_docs`` documents."""
    out = probes.select(["key", "low", "high"])
    if not arrays.num_rows or not probes.num_rows:
        return out.slice(0, 0)
    row = arrays.to_pylist()[0]
    numbers = PerfectHash.load(row["sizes"], row["bits"], row["rest"])
    prints, counts = np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["counts"], np.uint32)
    low, high = _unsigned(probes["low"]), _unsigned(probes["high"])
    at = numbers.index(low, high)
    ours = (at >= 0) & (prints[at] == low ^ (high << np.uint64(1)))
    return out.filter(pa.array(ours & (counts[at] >= min_docs)))


def _drop(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("_text")).cast(pa.binary()).to_pylist()
        lost = batch.column(batch.schema.get_field_index("_lost")).to_pylist()
        kept, n_lines, n_dropped = [], [], []
        for text, bad in zip(texts, lost):
            lines = (text or b"").split(b"\n")
            left = lines
            if bad:
                bad = {struct.pack("<qq", b["low"], b["high"]) for b in bad}
                left = [x for x, h in zip(lines, _key_hashes(text, min_chars)) if h not in bad]
            kept.append(b"\n".join(left))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["_row", "n_lines", "n_dropped", "kept_text"],
        )


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``keep`` (else the key), line counts and the text of the lines that stay, a row per input row."""
    spark = docs.sparkSession
    prepare(spark)
    carried = list(keep or (key,))
    kind = docs.schema[key].dataType.simpleString()
    lines = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        lambda b: _hashes(b, min_chars), f"key {kind}, low bigint, high bigint"
    )
    lines = materialize(lines, "line-hashes")
    counted = materialize(lines.groupBy("low", "high").agg(F.count("*").alias("docs")), "line-counts")
    shards = max(1, -(-counted.count() // SHARD_KEYS))
    shard = F.pmod("low", F.lit(shards).cast("bigint")).alias("shard")
    arrays = counted.select(shard, "low", "high", "docs").groupBy("shard").applyInArrow(_build, BUILT_DDL)
    arrays = materialize(arrays, "line-arrays")
    # Shards with hot lines: at most total probes / PROBES rows.
    hot = F.broadcast(arrays.where("copies > 1").select("shard", "copies"))
    probes = lines.select("key", "low", "high", shard).join(hot, "shard", "left")
    probes = probes.withColumn("copy", F.pmod(F.xxhash64("key"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    spread = arrays.withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest("copies", F.lit(1)) - 1)))
    spread = spread.drop("copies")
    found = (
        spread.groupBy("shard", "copy")
        .cogroup(probes.groupBy("shard", "copy"))
        .applyInArrow(lambda a, b: _probe(a, b, min_docs), f"key {kind}, low bigint, high bigint")
    )
    lost = found.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("_lost")).withColumnRenamed("key", "_key")
    rows = docs.select(F.struct(*carried).alias("_row"), F.col(key).alias("_id"), F.col(text).alias("_text"))
    rows = rows.join(lost, F.col("_id").eqNullSafe(F.col("_key")), "left").select("_row", "_text", "_lost")
    row_type = T.StructType([docs.schema[c] for c in carried])
    schema = T.StructType(
        [
            T.StructField("_row", row_type),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    out = rows.mapInArrow(lambda b: _drop(b, min_chars), schema)
    return out.select(*[F.col("_row")[c].alias(c) for c in carried], "n_lines", "n_dropped", "kept_text")


def clean(docs: DataFrame, **options) -> DataFrame:
    """All documents with their repeated lines taken out; ``n_chars``, if there, follows the text."""
    done = dedup_lines(docs, keep=tuple(docs.columns), **options)
    changed = {"text": F.when(F.col("text").isNull(), None).otherwise(F.col("kept_text")).alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(F.coalesce("kept_text", F.lit(""))).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return done.select(*[changed.get(c, F.col(c)) for c in docs.columns])
