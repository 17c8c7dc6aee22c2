"""Exact top-k search by inner product of quantised vectors.

Queries and shards are multiplied tile by tile, each tile keeps the ``k`` best of every
query by a partial selection, and the lists of a query are merged as a tree (tiles.py).
Nothing is approximated and no candidate is left out.

Defined results: rows with a null id, a null vector, or null or non-finite components take no
part; rows with the query's own id are not its candidates; a repeated query row is answered each
time, a repeated candidate row may take several ranks; equal scores go by the smaller id; a vector
without components scores 0 with all, and a shorter vector is followed by zeros; components saturate
at 2^53 after scaling and scores at the limits of a long; other columns are not read; without
candidates a query has no rows, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import tiles

FOUND = "query_id bigint, rank int, vec_id bigint, score bigint"


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row that is a query."""
    usable = vectors.where(F.col(vec_id).isNotNull() & tiles.usable(vector))
    rows = usable.select(
        F.col(vec_id).alias("id"), F.lit(0).alias("label"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("_q")
    )
    sizes = rows.agg(F.count("*").alias("all"), F.count_if("_q").alias("queries")).first()
    context = vectors.sparkSession.sparkContext
    grid = tiles.Grid.of(sizes["queries"], sizes["all"], context.defaultParallelism)
    queries = tiles.blocks(rows.where("_q"), scale)
    found = tiles.tile_lists(queries, tiles.blocks(rows, scale), grid, _selector(k), k)
    lists = tiles.merge_tree(found, grid, k)
    named = lists.join(queries.select("block", F.col("ids").alias("query_ids")), "block")
    return named.select("n", "k", "scores", "ids", "query_ids").mapInArrow(_ranked, FOUND)


def _selector(k: int):
    def select(row: dict, queries: tiles.Block, shard: tiles.Block) -> tuple[np.ndarray, np.ndarray]:
        step = max(1, tiles.TILE_CELLS // max(1, len(shard.ids)))
        parts = []
        for at in range(0, len(queries.ids), step):
            mine = slice(at, at + step)
            scores, bound = tiles.products(queries.matrix[mine], shard.matrix)
            keys = tiles.order_keys(scores, bound)
            tiles.without_own(keys, queries.ids[mine], shard.ids)
            parts.append(tiles.pick(scores, keys, shard.ids, k))
        return tuple(np.concatenate([p[i] for p in parts]) for i in (0, 1))

    return select


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            scores, ids = tiles.read_lists(row)
            mine = np.frombuffer(row["query_ids"], "<i8")
            query, place = np.nonzero(scores != tiles.EMPTY)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mine[query]),
                    pa.array(place.astype(np.int32) + 1, pa.int32()),
                    pa.array(ids[query, place]),
                    pa.array(scores[query, place]),
                ],
                names=["query_id", "rank", "vec_id", "score"],
            )
