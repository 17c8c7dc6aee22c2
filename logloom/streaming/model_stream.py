"""Scoring a stream with the fitted feature model.

Windowed features of a row need all rows of its window, and the gap to the row before
needs that row.  So rows wait until the watermark closes the span of time that holds
all their windows, and are then scored as one batch against the saved tables.

What a stream remembers lies in tables under one folder, by micro-batch:

* ``held``: the rows of a micro-batch, with the span each belongs to;
* ``progress``: one row per micro-batch, written last.  It says up to which time spans are closed, the
  last time that was scored, and which micro-batches still hold open spans.

A micro-batch reads the progress of the one before and nothing older, and every write
replaces the folder of its own number.  A micro-batch that is repeated after a failure
therefore makes the same tables again, whatever the failed attempt left behind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.timestamps import window_start
from logloom.models.registry import Detector
from logloom.operators.assemble import FeatureModel
from logloom.schema import ROW_ID
from logloom.sources.store import delete_path, path_exists
from logloom.streaming.streams import BATCH_SECONDS

PROGRESS = (
    "batch_id bigint, closed_until bigint, max_time timestamp, last_time timestamp, "
    "open array<struct<batch_id: bigint, last_span: bigint>>, done array<bigint>, n_rows bigint, n_late bigint"
)


@dataclass
class ModelStream:
    """``foreachBatch`` function that scores rows of closed spans.

    ``delay_minutes`` is how long after the newest time seen a row may still arrive; a row of a span
    that is closed already is late: it is counted, not scored.  Rows without a time belong to no window and
    are scored at once.
    """

    features: FeatureModel
    detector: Detector
    path: str
    delay_minutes: int = 10
    ts: str = "timestamp"
    _span: int = field(init=False)

    def __post_init__(self) -> None:
        self._span = math.lcm(*self.features.sizes)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self._progress(spark, batch_id - 1)
        for old in before["done"]:
            delete_path(spark, f"{self.path}/held/batch_id={old}")
        span = window_start(self.ts, self._span)
        late = F.lit(False) if before["closed_until"] is None else F.coalesce(span < before["closed_until"], F.lit(False))
        held = f"{self.path}/held/batch_id={batch_id}"
        batch.withColumns({"_span": span, "_late": late}).write.mode("overwrite").parquet(held)
        now = spark.read.parquet(held).agg(
            F.count("*").alias("n"),
            F.count_if("_late").alias("late"),
            F.max(self.ts).alias("t"),
            F.max("_span").alias("last_span"),
            F.max(F.unix_micros(self.ts)).alias("us"),
        ).first()
        max_time = max((t for t in (before["max_time"], now["t"]) if t is not None), default=None)
        closed = before["closed_until"]
        if now["us"] is not None:
            minute = now["us"] // 60_000_000 - self.delay_minutes
            found = minute - minute % self._span
            closed = found if closed is None else max(closed, found)
        waiting = [*before["open"], {"batch_id": batch_id, "last_span": now["last_span"]}]
        self._score(spark, batch_id, before, closed, max_time, waiting, now["n"], now["late"])

    def finish(self, spark: SparkSession) -> None:
        """Score what is still held, once no more rows will come."""
        found = spark.read.schema(PROGRESS).parquet(f"{self.path}/progress").agg(F.max("batch_id")).first()[0]
        if found is None:
            return
        before = self._progress(spark, found)
        if before["open"]:
            last = max((o["last_span"] for o in before["open"] if o["last_span"] is not None), default=None)
            closed = before["closed_until"] if last is None else last + self._span
            self._score(spark, found + 1, before, closed, before["max_time"], before["open"], 0, 0)

    def _progress(self, spark: SparkSession, batch_id: int) -> dict:
        path = f"{self.path}/progress/batch_id={batch_id}"
        if batch_id >= 0 and path_exists(spark, path):
            return spark.read.schema(PROGRESS).parquet(path).first().asDict(recursive=True)
        none = dict.fromkeys(("closed_until", "max_time", "last_time"))
        return none | {"open": [], "done": []}

    def _score(self, spark, batch_id, before, closed, max_time, waiting, n_rows, n_late) -> None:
        ready = self._ready(spark, batch_id, before["closed_until"], closed, waiting)
        last_time = before["last_time"]
        if ready is not None:
            features = self.features.transform(ready, stats="fitted", before=last_time)
            added = self.detector.score(features, bounds="fitted")
            kept = [c for c in ready.columns if c == ROW_ID or c not in added.columns]
            ready.select(*kept).join(added, ROW_ID).write.mode("overwrite").parquet(f"{self.path}/scored/batch_id={batch_id}")
            newest = ready.agg(F.max(self.ts)).first()[0]
            last_time = newest if newest is not None else last_time
        left = [w for w in waiting if w["last_span"] is not None and (closed is None or w["last_span"] >= closed)]
        done = [w["batch_id"] for w in waiting if w not in left]
        opened = [(w["batch_id"], w["last_span"]) for w in left]
        row = (batch_id, closed, max_time, last_time, opened, done, n_rows, n_late)
        spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/progress/batch_id={batch_id}"
        )

    def _ready(self, spark, batch_id, closed_before, closed, waiting) -> DataFrame | None:
        """Rows of the spans that close now, and rows without a time of this micro-batch."""
        paths = [f"{self.path}/held/batch_id={w['batch_id']}" for w in waiting if path_exists(spark, f"{self.path}/held/batch_id={w['batch_id']}")]
        if not paths:
            return None
        rows = spark.read.parquet(*paths).withColumn("_file", F.input_file_name())
        timeless = F.col("_span").isNull() & F.col("_file").contains(f"/batch_id={batch_id}/")
        inside = F.lit(False)
        if closed is not None:
            inside = F.coalesce(F.col("_span") < closed, F.lit(False))
            if closed_before is not None:
                inside = inside & (F.col("_span") >= closed_before)
        ready = rows.where(~F.col("_late") & (inside | timeless)).drop("_span", "_late", "_file", "batch_id")
        return None if ready.isEmpty() else ready


def write_model_scores(rows: DataFrame, scoring: ModelStream, checkpoint: str, available_now: bool = False):
    """Start the query.  Scored rows appear under ``<path>/scored``, a folder per micro-batch."""
    writer = rows.writeStream.foreachBatch(scoring).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{BATCH_SECONDS} seconds"}
    return writer.trigger(**trigger).start()


def model_scores(spark: SparkSession, path: str) -> DataFrame:
    """All rows scored so far."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/scored")


def stream_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: rows, late rows, and up to which minute spans are closed."""
    return spark.read.schema(PROGRESS).parquet(f"{path}/progress").select(
        "batch_id", "n_rows", "n_late", "closed_until", "max_time"
    )
