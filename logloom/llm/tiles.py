"""Tiles of query blocks by vector shards, and top lists that are merged as a tree.

Vectors are quantised to whole numbers and packed into blocks: a row of a block table holds
the ids of up to ``CHUNK`` vectors in ascending order, their labels and one matrix.  Query
blocks are dealt to row bands and shards to column bands of a grid; the cell of a row
and a column is one group of a shuffle and holds at most ``QUERY_BAND`` queries and
``SHARD_BAND`` vectors on average, however many rows there are.  In a cell every (query
block, shard) tile is one matrix product, of which a partial selection keeps the best
few; lists of one query block from all columns then meet ``FAN_IN`` at a time.

Products are exact: floating-point matrices while every sum stays below the last whole
number they hold, 64-bit integers beyond, Python integers (saturated to a long) at last.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import prepare

CHUNK = 1024
QUERY_BAND, SHARD_BAND = 65_536, 262_144
FAN_IN = 16
# More cells than this share tasks.
MOST_TASKS = 32_768
TILE_CELLS = 4 * 1024 * 1024
# An empty place of a list; real scores are greater.
EMPTY = np.iinfo(np.int64).min
MOST = 2**53

_BLOCK = "block bigint, n int, width int, item int, ids binary, labels binary, matrix binary"
LISTS = "block bigint, node bigint, n int, k int, scores binary, ids binary"


def usable(vector: str) -> Column:
    """No null vector, and no null or non-finite component."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


@dataclass
class Block:
    key: int
    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        kind = np.dtype(f"<i{row['item']}")
        return cls(
            row["block"],
            np.frombuffer(row["ids"], "<i8"),
            np.frombuffer(row["labels"], "<i8"),
            np.frombuffer(row["matrix"], kind).reshape(row["n"], row["width"]),
        )


def _packer(scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def matrix(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        whole = np.clip(np.floor(flat.astype(np.float64) * scale), -MOST, MOST).astype(np.int64)
        width = int(lengths.max(initial=0))
        if len(lengths) and (lengths == width).all():
            return whole.reshape(len(lengths), width)
        out = np.zeros((len(lengths), width), np.int64)
        out[np.arange(width)[None, :] < lengths[:, None]] = whole
        return out

    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        rows = 0

        def packed():
            nonlocal held, rows, made
            width = max(m.shape[1] for _, _, m in held)
            whole = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m in held])
            ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            order = np.argsort(ids, kind="stable")
            most = int(np.abs(whole).max(initial=0))
            item = next(b for b in (1, 2, 4, 8) if most < 2 ** (8 * b - 1))
            row = [
                base + made, len(ids), width, item, ids[order].astype("<i8").tobytes(),
                labels[order].astype("<i8").tobytes(), whole[order].astype(f"<i{item}").tobytes(),
            ]
            made += 1
            held, rows = [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            whole, at = matrix(flat, lengths), 0
            while at < len(ids):
                end = min(len(ids), at + CHUNK - rows)
                held.append((ids[at:end], labels[at:end], whole[at:end]))
                rows += end - at
                at = end
                if rows == CHUNK:
                    yield packed()
        if rows:
            yield packed()

    return run


def blocks(vectors: DataFrame, scale: float) -> DataFrame:
    """Blocks of (id, label, vector) rows, each component x taken as floor(scale * x).

    Vectors of different lengths are compared as if zeros followed the shorter one.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), "vector")
    return rows.mapInArrow(_packer(scale), _BLOCK)


@dataclass
class Grid:
    rows: int
    columns: int

    @classmethod
    def of(cls, n_queries: int, n_vectors: int, tasks: int) -> Grid:
        """Bands of bounded size, and columns enough to keep ``tasks`` busy."""
        rows = max(1, math.ceil(n_queries / QUERY_BAND))
        least = min(math.ceil(2 * tasks / rows), math.ceil(n_vectors / CHUNK))
        return cls(rows, max(1, math.ceil(n_vectors / SHARD_BAND), least))


def products(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """All inner products of the rows of two whole-number matrices, and a bound of their size."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    bound = int(np.abs(a.astype(np.int64)).max(initial=0)) * int(np.abs(b.astype(np.int64)).max(initial=0)) * width
    if bound < 2**24:
        return a.astype(np.float32) @ b.astype(np.float32).T, bound
    if bound < MOST:
        return a.astype(np.float64) @ b.astype(np.float64).T, bound
    if bound < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T, bound
    return np.clip(a.astype(object) @ b.astype(object).T, EMPTY + 1, np.iinfo(np.int64).max).astype(np.int64), 2**63


def order_keys(scores: np.ndarray, bound: int) -> np.ndarray:
    """Numbers that order a row of a tile by score, equal scores by position; the largest comes first.

    Shards are sorted by id, so position is id.
    """
    n = scores.shape[1]
    back = np.arange(n - 1, -1, -1)
    if (bound + 1) * n < MOST:
        return scores.astype(np.float64) * n + back
    ranks = np.lexsort((np.broadcast_to(back, scores.shape), scores), axis=-1)
    keys = np.empty(scores.shape)
    np.put_along_axis(keys, ranks, np.broadcast_to(np.arange(n, dtype=float), scores.shape), axis=-1)
    return keys


def pick(scores: np.ndarray, keys: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The scores and ids of the ``k`` largest keys of each row; keys of minus infinity are no candidates."""
    n = scores.shape[1]
    at = np.argpartition(keys, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    found = np.take_along_axis(scores, at, axis=1).astype(np.int64)
    found[np.isneginf(np.take_along_axis(keys, at, axis=1))] = EMPTY
    return found, np.where(found == EMPTY, 0, ids[at])


def without_own(keys: np.ndarray, query_ids: np.ndarray, ids: np.ndarray) -> None:
    """Rows with the query's own id are no candidates."""
    low, high = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    for i in np.flatnonzero(high > low):
        keys[i, low[i] : high[i]] = -np.inf


def best(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """One list per row out of several: scores descending, equal scores by id."""
    scores, ids = (np.concatenate([p[i] for p in parts], axis=1) for i in (0, 1))
    order = np.lexsort((ids, ~scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _list_row(block: int, node: int, scores: np.ndarray, ids: np.ndarray) -> dict:
    n, k = scores.shape
    return {"block": block, "node": node, "n": n, "k": k, "scores": scores.tobytes(), "ids": ids.tobytes()}


_LIST_TYPES = pa.schema(
    [("block", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), ("scores", pa.binary()), ("ids", pa.binary())]
)


def read_lists(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c], "<i8").reshape(row["n"], row["k"]) for c in ("scores", "ids"))


def tile_lists(
    queries: DataFrame,
    shards: DataFrame,
    grid: Grid,
    select: Callable[[dict, Block, Block], tuple[np.ndarray, np.ndarray]],
    k: int,
) -> DataFrame:
    """(block, node, lists): the best of every query block in every column of the grid.

    ``select(query_row, query_block, shard)`` gives the lists of one tile.  A query row may carry more
    columns than a block has.
    """

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        node = key[0].as_py() % grid.columns
        loaded = [Block.read(r) for r in right.to_pylist()]
        for row in left.to_pylist():
            mine, found = Block.read(row), None
            for shard in loaded:
                part = select(row, mine, shard)
                found = best([part] if found is None else [found, part], k)
            if found is not None:
                rows.append(_list_row(row["block"], node, *found))
        return pa.Table.from_pylist(rows, _LIST_TYPES)

    band = F.pmod(F.xxhash64("block"), F.lit(grid.rows))
    every_column = F.explode(F.sequence(F.lit(0), F.lit(grid.columns - 1)))
    left = queries.select("*", every_column.alias("_c")).withColumn("cell", band * grid.columns + F.col("_c")).drop("_c")
    column = F.pmod(F.xxhash64("block"), F.lit(grid.columns))
    every_row = F.explode(F.sequence(F.lit(0), F.lit(grid.rows - 1)))
    right = shards.select("*", every_row.alias("_r")).withColumn("cell", F.col("_r").cast("bigint") * grid.columns + column).drop("_r")
    # Cells are few and small but dear, so they are spread by number, not coalesced by size.
    parts = min(2 * grid.rows * grid.columns, MOST_TASKS)
    sides = [side.repartition(parts, "cell").groupBy("cell") for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(cell, LISTS)


def merge_tree(lists: DataFrame, grid: Grid, k: int) -> DataFrame:
    """One row of lists per query block."""

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        block, node = (x.as_py() for x in key)
        parts = [read_lists(r) for r in table.to_pylist()]
        return pa.Table.from_pylist([_list_row(block, node, *best(parts, k))], _LIST_TYPES)

    width = grid.columns
    while width > 1:
        width = math.ceil(width / FAN_IN)
        up = lists.withColumn("node", F.floor(F.col("node") / FAN_IN))
        lists = up.groupBy("block", "node").applyInArrow(merged, LISTS)
    return lists
