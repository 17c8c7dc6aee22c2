"""Synchronous data-parallel sums over blocks of rows, equal to the last bit on any cluster.

Rows are packed once: a hash of the row key says which group (a mini-batch of every epoch) and which
block of it a row belongs to, and a block is one row of a written table with its rows in the order of
their keys.  A block so gives the same numbers wherever it is read.  What blocks contribute is rounded to
whole multiples of a power of two and added up as integers, so the order of addition,
the number of partitions and the size of Arrow batches don't matter either.

A task adds up its blocks and sends one packed vector; vectors are added as a tree, so
the driver receives at most ``LAST_VECTORS`` of them however many tasks there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.models.matrix import chunks, feature_block, is_sparse
from logloom.schema import ROW_ID
from logloom.session import scratch_dir, ship_package

BLOCK_ROWS, FAN_IN, LAST_VECTORS = 512, 32, 4
# Contributions to a mean are kept to 2^-44.
FRACTION_BITS = 44

_PACKED = "grp int, block bigint, n int, lengths binary, indices binary, values binary"


@dataclass
class Blocks:
    """A written table of packed rows; ``counts`` has the rows of every group."""

    table: DataFrame
    size: int
    counts: list[int]
    parts: list[int]

    @property
    def n_rows(self) -> int:
        return sum(self.counts)

    @classmethod
    def pack(cls, df: DataFrame, size: int, groups: int = 1) -> "Blocks":
        spark = df.sparkSession
        ship_package(spark)
        n_rows = df.count()
        per_group = max(1, math.ceil(n_rows / (groups * BLOCK_ROWS)))
        sparse = is_sparse(df)
        draw = F.xxhash64(F.lit("block"), ROW_ID)
        group = F.pmod(draw, F.lit(groups)).cast("int")
        block = group.cast("bigint") * per_group + F.pmod(F.shiftrightunsigned(draw, 24), F.lit(per_group))

        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(ROW_ID)
            lengths = indices = b""
            if sparse:
                cells = [(v["indices"], v["values"]) for v in pdf["features"]]
                lengths = np.array([len(i) for i, _ in cells], np.int32).tobytes()
                indices = np.concatenate([np.asarray(i, np.int32) for i, _ in cells]).tobytes()
                values = np.concatenate([np.asarray(v, float) for _, v in cells]).tobytes()
            else:
                values = np.stack(pdf["features"].to_list()).astype(float).tobytes()
            row = (int(pdf["grp"].iloc[0]), int(pdf["block"].iloc[0]), len(pdf), lengths, indices, values)
            return pd.DataFrame([row], columns=[c.split()[0] for c in _PACKED.split(", ")])

        rows = df.select(ROW_ID, "features", group.alias("grp"), block.alias("block"))
        path = scratch_dir(spark, "blocks")
        made = rows.groupBy("grp", "block").applyInPandas(pack, _PACKED)
        made.write.partitionBy("grp").parquet(path)
        table = spark.read.schema(made.schema).parquet(path)
        found = dict(table.groupBy("grp").agg(F.sum("n")).collect())
        parts = [table.where(F.col("grp") == g).rdd.getNumPartitions() for g in range(groups)]
        return cls(table, size, [int(found.get(g, 0)) for g in range(groups)], parts)

    def sum(self, per_block: Callable[[np.ndarray], np.ndarray], width: int, positions, dims: int, group: int | None = None) -> np.ndarray:
        """The mean over rows of what ``per_block(rows of a block)`` sums up, over one group or all."""
        table = self.table if group is None else self.table.where(F.col("grp") == group)
        n = self.n_rows if group is None else self.counts[group]
        size = self.size

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width, np.int64)
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    found = per_block(read_block(row, size, positions, dims)) / n
                    total += np.rint(np.ldexp(np.clip(found, -(2.0**16), 2.0**16), FRACTION_BITS)).astype(np.int64)
            yield pd.DataFrame({"v": [total.tobytes()]})

        vectors = table.select("n", "lengths", "indices", "values").mapInPandas(run, "v binary")
        total = vector_sum(vectors, sum(self.parts) if group is None else self.parts[group], width)
        return np.ldexp(total.astype(float), -FRACTION_BITS)


def read_block(row, size: int, positions: np.ndarray | None, dims: int) -> np.ndarray:
    """The rows of a block as a dense matrix of ``dims`` columns."""
    values = np.frombuffer(row.values)
    if not row.lengths:
        frame = pd.Series(list(values.reshape(row.n, -1)))
        return feature_block(frame, size, positions=positions, width=dims)
    lengths, columns = np.frombuffer(row.lengths, np.int32), np.frombuffer(row.indices, np.int32).astype(np.int64)
    rows = np.repeat(np.arange(row.n), lengths)
    if positions is not None:
        columns = positions[columns]
    out = np.zeros((row.n, dims))
    np.add.at(out, (rows, columns), values)
    return out


def vector_sum(vectors: DataFrame, parts: int, width: int) -> np.ndarray:
    """Sum of packed integer vectors, ``FAN_IN`` at a time until a few are left."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width, np.int64)
        for pdf in batches:
            for v in pdf["v"]:
                total += np.frombuffer(v, np.int64)
        yield pd.DataFrame({"v": [total.tobytes()]})

    while parts > LAST_VECTORS:
        parts = math.ceil(parts / FAN_IN)
        vectors = vectors.repartition(parts).mapInPandas(add, "v binary")
    total = np.zeros(width, np.int64)
    for row in vectors.collect():  # a few vectors
        total += np.frombuffer(row["v"], np.int64)
    return total


def exact_sums(df: DataFrame, of: Callable[[pd.DataFrame], np.ndarray], bounds: np.ndarray, n_rows: int) -> np.ndarray:
    """Column sums of the matrices ``of(batch)``, whose columns are bounded by ``bounds``.

    Every column is rounded at a power of two that lets the sum of ``n_rows`` fit 63 bits.
    """
    width = len(bounds)
    bits = 61 - math.ceil(math.log2(max(n_rows, 2))) - np.ceil(np.log2(np.maximum(bounds, 1e-300))).astype(int)
    bits = np.clip(bits, -1000, 1000)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width, np.int64)
        for pdf in batches:
            for part in chunks(pdf):
                total += np.rint(np.ldexp(of(part), bits)).astype(np.int64).sum(axis=0)
        yield pd.DataFrame({"v": [total.tobytes()]})

    vectors = df.select("features").mapInPandas(run, "v binary")
    return np.ldexp(vector_sum(vectors, vectors.rdd.getNumPartitions(), width).astype(float), -bits)
