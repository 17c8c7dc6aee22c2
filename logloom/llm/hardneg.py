"""Hard negatives for every (anchor, positive), by slots of the score range.

An anchor's positives are its best rows of the same label.  Each positive with score p allows
negatives between ``low`` and ``high`` percent of p; these windows overlap.  The upper limits of an anchor's
positives, in falling order, cut the scores into disjoint slots: slot j holds what is above
the limit of the next positive and not above its own.  Every tile keeps the ``k`` best rows
of another label per slot, lists are merged as a tree, and a positive reads its slot and the
slots below it in falling order: their first ``k`` rows are the best rows under its limit, of which those above
its lower limit are its negatives.  One pass over all pairs so answers all windows of an anchor.

Defined results: rows with a null id or label, a null vector, or null or non-finite components take no
part; rows with the anchor's own id are neither its positives nor its negatives; a repeated
anchor row is answered each time, repeated other rows may take several places; equal scores go by
the smaller id; a positive with a negative score has an empty window; lengths and large numbers as in tiles.py; other columns are
not read; an anchor without positives has no rows, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import tiles
from logloom.llm.common import materialize

MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
# Below every score: the limit of a positive that is not there.
NO_LIMIT = tiles.EMPTY


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    k: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    usable = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & tiles.usable(vector))
    rows = usable.select(
        F.col(vec_id).alias("id"),
        F.col(label).alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("_q"),
    )
    sizes = rows.agg(F.count("*").alias("all"), F.count_if("_q").alias("anchors")).first()
    grid = tiles.Grid.of(sizes["anchors"], sizes["all"], vectors.sparkSession.sparkContext.defaultParallelism)
    shards = tiles.blocks(rows, scale)
    anchors = materialize(tiles.blocks(rows.where("_q"), scale), "anchors")

    near = tiles.merge_tree(tiles.tile_lists(anchors, shards, grid, _positives(n_positives), n_positives), grid, n_positives)
    renamed = near.select("block", F.col("k").alias("n_positives"), F.col("scores").alias("positive_scores"), F.col("ids").alias("positives"))
    limited = materialize(anchors.join(renamed, "block"), "positives")

    slots = tiles.merge_tree(tiles.tile_lists(limited, shards, grid, _slots(k, high), k), grid, k)
    answered = slots.join(limited.select("block", F.col("ids").alias("anchors"), "n_positives", "positive_scores", "positives"), "block")
    return answered.mapInArrow(_windows(k, low, high), MINED)


def _in_steps(queries: tiles.Block, shard: tiles.Block, one: Callable[[slice, np.ndarray, np.ndarray], tuple]):
    step = max(1, tiles.TILE_CELLS // max(1, len(shard.ids)))
    parts = []
    for at in range(0, len(queries.ids), step):
        part = slice(at, min(len(queries.ids), at + step))
        scores, bound = tiles.products(queries.matrix[part], shard.matrix)
        keys = tiles.order_keys(scores, bound)
        tiles.without_own(keys, queries.ids[part], shard.ids)
        parts.append(one(part, scores, keys))
    return tuple(np.concatenate([p[i] for p in parts]) for i in (0, 1))


def _positives(k: int):
    def select(row: dict, anchors: tiles.Block, shard: tiles.Block):
        def one(part, scores, keys):
            keys[anchors.labels[part, None] != shard.labels[None, :]] = -np.inf
            return tiles.pick(scores, keys, shard.ids, k)

        return _in_steps(anchors, shard, one)

    return select


def _positive_lists(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    shape = (n, row["n_positives"])
    return tuple(np.frombuffer(row[c], "<i8").reshape(shape) for c in ("positive_scores", "positives"))


def percent(scores: np.ndarray, share: int) -> np.ndarray:
    """floor(share * score / 100), without leaving 64 bits."""
    return scores // 100 * share + scores % 100 * share // 100


def upper_limits(scores: np.ndarray, high: int) -> np.ndarray:
    """The largest score that a negative of each positive may have; they fall as the positives do."""
    return np.where(scores == tiles.EMPTY, NO_LIMIT, percent(scores, high))


def _slots(k: int, high: int):
    def select(row: dict, anchors: tiles.Block, shard: tiles.Block):
        limits = upper_limits(_positive_lists(row, len(anchors.ids))[0], high)
        limits = np.concatenate([limits, np.full((len(limits), 1), NO_LIMIT)], axis=1)

        def one(part, scores, keys):
            keys[anchors.labels[part, None] == shard.labels[None, :]] = -np.inf
            whole = scores.astype(np.int64)
            found = []
            for j in range(limits.shape[1] - 1):
                inside = (whole <= limits[part, j, None]) & (whole > limits[part, j + 1, None])
                found.append(tiles.pick(scores, np.where(inside, keys, -np.inf), shard.ids, k))
            # A list per (anchor, slot): rows of one anchor follow each other.
            return tuple(np.stack([f[i] for f in found], axis=1).reshape(-1, found[0][0].shape[1]) for i in (0, 1))

        return _in_steps(anchors, shard, one)

    return select


def _windows(k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["anchors"], "<i8")
                p_scores, p_ids = _positive_lists(row, len(ids))
                slot_scores, slot_ids = (x.reshape(len(ids), p_scores.shape[1], -1) for x in tiles.read_lists(row))
                out: list[list[np.ndarray]] = []
                below = None
                # From the lowest slot up: what a positive sees is its slot, then what the next one sees.
                for j in reversed(range(p_scores.shape[1])):
                    own = (slot_scores[:, j], slot_ids[:, j])
                    below = tiles.best([own] if below is None else [own, below], k)
                    p = p_scores[:, j]
                    # 100 * negative >= low * positive
                    least = -percent(-np.where(p == tiles.EMPTY, 0, p), low)
                    there = (below[0] != tiles.EMPTY) & (p != tiles.EMPTY)[:, None] & (below[0] >= least[:, None])
                    a, place = np.nonzero(there)
                    out.append([ids[a], p_ids[a, j], place + 1, below[1][a, place], p[a], below[0][a, place]])
                columns = [np.concatenate([o[i] for o in out]) for i in range(6)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds)],
                    names=[c.split()[0] for c in MINED.split(", ")],
                )

    return run
