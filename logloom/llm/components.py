"""Connected components of an edge table by union-find, partition by partition.

Each round puts all edges of a node into one partition, merges what a
partition holds with a union-find, and replaces every root by the smallest
root known for it.  Rounds end when every node has one root that is final.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import materialize, prepare


class UnionFind(dict):
    """Smallest member as root, paths halved on the way."""

    def root(self, x):
        parent = self.setdefault(x, x)
        while parent != x:
            self[x] = parent = self[parent]
            x, parent = parent, self[parent]
        return x

    def union(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        return True


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets, schema = UnionFind(), None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
    if schema is not None:
        nodes = list(sets)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, schema.field(0).type), pa.array([sets.root(x) for x in nodes], schema.field(0).type)],
            names=["node", "root"],
        )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest reachable node."""
    prepare(edges.sparkSession)
    kind = edges.schema["a"].dataType.simpleString()
    pairs = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    while True:
        forest = materialize(pairs.repartition("node").mapInArrow(_merge, f"node {kind}, root {kind}"), "forest")
        best = forest.groupBy("node").agg(F.min("root").alias("best"))
        lead = best.select(F.col("node").alias("root"), "best")
        moved = materialize(forest.join(lead, "root").select("node", "root", F.col("best")).distinct(), "moved")
        left = moved.agg(
            F.coalesce(F.sum((F.col("root") != F.col("best")).cast("int")), F.lit(0)).alias("stale"),
            F.count("*").alias("rows"),
        ).first()
        nodes = best.count()
        pairs = moved.select("node", F.col("best").alias("root")).distinct()
        if left["stale"] == 0 and left["rows"] == nodes:
            return pairs
