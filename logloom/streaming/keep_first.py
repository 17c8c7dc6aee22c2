"""Keep-first de-duplication of a stream by event time, not by arrival.

For every key the state holds the earliest row seen.  When the watermark has passed that row's time no
earlier row can come any more, and a timer releases it.  What arrives for the key afterwards is a repeat.

Keys share ``BUCKETS`` groups by a hash, so a micro-batch calls Python once per bucket, not once per key; the
state of a bucket names its keys, and its timer is that of the key that is due first.

Before the shuffle every Arrow batch keeps its earliest row per key, so a key with most rows
sends one row per batch, not one per repeat.

Defined results: first is the smallest (time, row key); a row without a time comes after all
others and is released at the next step of the watermark; NULL keys are one key; rows later than the watermark
may repeat a released key and are then dropped, and count as new keys otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logloom.schema import ROW_ID
from logloom.session import ship_package

# Later than any time.
_NO_TIME = 4 * 10**18
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Groups that the keys are dealt to.
BUCKETS = 4096


def keep_first_stream(
    df: DataFrame,
    keys: Sequence[str],
    delay: str = "10 minutes",
    forget_minutes: int | None = None,
    ts: str = "timestamp",
    row_id: str = ROW_ID,
) -> DataFrame:
    """The first row of every key, emitted once nothing earlier can arrive.

    Keys are remembered for good, or for ``forget_minutes`` of event time after their release: a
    repeat after that is a first row again, and the state stays bounded.
    """
    ship_package(df.sparkSession)
    keyed = [_key_value(df, k).alias(f"k{i}") for i, k in enumerate(keys)]
    micros = F.coalesce(F.unix_micros(ts), F.lit(_NO_TIME)).alias("_us")
    rows = df.select(
        F.to_json(F.struct(*keyed), _JSON).alias("_key"),
        F.col(ts).alias("_ts"),
        micros,
        F.col(row_id).cast("bigint").alias("_id"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns]), _JSON).alias("_row"),
    )
    combined = rows.mapInPandas(_earliest(["_key"]), "_key string, _ts timestamp, _us bigint, _id bigint, _row string")
    forget = None if forget_minutes is None else forget_minutes * 60_000

    def held(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        # Waiting keys have (time, row key, row, when it is due), released ones when they are forgotten.
        waiting, released = (json.loads(text) for text in state.get) if state.exists else ({}, {})
        visited = set()
        for pdf in () if state.hasTimedOut else batches:
            for name, *found in zip(pdf["_key"], pdf["_us"].tolist(), pdf["_id"].tolist(), pdf["_row"]):
                visited.add(name)
                if name not in released and (name not in waiting or found[:2] < waiting[name][:2]):
                    waiting[name] = found
        for name in visited:
            if name in released:
                # A timer is set anew whenever a key is visited.
                released[name] = None if forget is None else now + forget
            else:
                us = waiting[name][0]
                due = now if us == _NO_TIME else -(-us // 1000)
                waiting[name] = [*waiting[name][:3], max(due, now) + 1]
        for name in [n for n, at in released.items() if n not in visited and at is not None and at < now]:
            del released[name]
        ready = [n for n, row in waiting.items() if n not in visited and row[3] < now]
        out = [waiting.pop(n)[2] for n in ready]
        if forget != 0:
            released.update(dict.fromkeys(ready, None if forget is None else now + forget))
        if waiting or released:
            state.update((json.dumps(waiting), json.dumps(released)))
            timers = [row[3] for row in waiting.values()] + [at for at in released.values() if at is not None]
            if timers:
                state.setTimeoutTimestamp(min(timers))
        else:
            state.remove()
        if out:
            yield pd.DataFrame({"_row": out})

    out = (
        combined.withWatermark("_ts", delay)
        .withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)))
        .groupBy("_bucket")
        .applyInPandasWithState(held, "_row string", "waiting string, released string", "append", GroupStateTimeout.EventTimeTimeout)
    )
    return out.select(F.from_json("_row", df.schema, _JSON).alias("r")).select("r.*")


def _key_value(df: DataFrame, name: str):
    """A key as grouping sees it: 0.0 and -0.0 are one."""
    floating = df.schema[name].dataType.simpleString() in ("float", "double")
    return F.col(name) + F.lit(0.0) if floating else F.col(name)


def _earliest(names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            pdf = pdf.reset_index(drop=True)
            first = pdf.sort_values(["_us", "_id"]).drop_duplicates(names).index.to_numpy()
            # The newest time moves the watermark, whether its row is a first one or not.
            timed = pdf["_ts"].dropna()
            newest = [timed.idxmax()] if len(timed) else []
            yield pdf.iloc[np.union1d(first, newest).astype(int)]

    return run
