"""Isolation trees over true fractions of a table, grown level by level.

A tree's sample may be most of a large table, so no task holds it.  Near the root,
rows stay where they are: every task routes its rows by the cuts known so far and reports, for each
open node, its rows and the range of a few features that were drawn for the node; Spark adds the reports up and the
driver gets one row per open node.  A node of at most ``task_rows`` rows is
closed: its rows meet in one task, which grows the rest of the branch in memory.

A node has a number: 1 is the root, 2 i and 2 i + 1 are the children of i.  Which rows belong to a tree,
which features a node draws and where it cuts come from hashes of (seed, tree, row key) and
(seed, tree, node), so a forest does not depend on partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.models.matrix import chunks, feature_block
from logloom.schema import ROW_ID
from logloom.session import materialize, ship_package

# Rows of a node that one task may hold, and features that a node draws at its first try.
TASK_ROWS, DRAWN = 100_000, 16
# Bytes of all rows, as a dense block, that one task may hold; parts that trees are dealt to then.
HELD_BYTES, SHARES = 128 * 1024 * 1024, 24

BRANCHES = (
    "tree int, root bigint, node int, feature int, threshold double, left int, right int, size int, depth int"
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_sample(row_ids: np.ndarray, tree: int, fraction: float, seed: int) -> np.ndarray:
    """Whether each row belongs to the tree's sample: all rows at a fraction of 1."""
    if fraction >= 1.0:
        return np.ones(len(row_ids), bool)
    start = np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return _mixed(_mixed(row_ids.astype(np.int64).view(np.uint64) ^ start) + start) < np.uint64(int(fraction * 2**64))


def drawn_features(seed: int, tree: int, node: int, size: int, tries: int) -> np.ndarray:
    """Features that the node looks at: the next part of its own order of all features."""
    order = np.random.default_rng([seed, tree, node]).permutation(size)
    first = 0 if tries == 0 else DRAWN * (4**tries - 1) // 3
    return order[first : first + DRAWN * 4**tries]


class Cuts:
    """Cuts found so far, by tree, for routing whole blocks."""

    def __init__(self, cuts: pd.DataFrame) -> None:
        self.by_tree = {}
        for tree, part in cuts.sort_values(["tree", "node"]).groupby("tree"):
            self.by_tree[int(tree)] = tuple(part[c].to_numpy() for c in ("node", "feature", "threshold"))

    def route(self, tree: int, x: np.ndarray) -> np.ndarray:
        """Number of the node that each row has come to."""
        at = np.ones(len(x), np.int64)
        if tree not in self.by_tree:
            return at
        nodes, features, cuts = self.by_tree[tree]
        moving = np.arange(len(x))
        while len(moving):
            place = np.minimum(np.searchsorted(nodes, at[moving]), len(nodes) - 1)
            inside = nodes[place] == at[moving]
            moving, place = moving[inside], place[inside]
            at[moving] = 2 * at[moving] + (x[moving, features[place]] > cuts[place])
        return at


@dataclass
class TopLevels:
    """What the driver knows of a forest: cuts near the roots, leaves among them, and closed nodes."""

    cuts: pd.DataFrame
    leaves: pd.DataFrame
    closed: pd.DataFrame


_TOP = {"tree": "int64", "node": "int64", "feature": "int64", "threshold": "float64", "size": "int64"}


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=list(_TOP)).astype(_TOP)


def _report(cuts: Cuts, open_: dict[int, dict[int, int]], size: int, fraction: float, seed: int):
    """Rows and ranges of drawn features per open node, one report per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[int, int], list] = {}
        drawn = {(t, n): drawn_features(seed, t, n, size, k) for t, nodes in open_.items() for n, k in nodes.items()}
        for pdf in batches:
            for part in chunks(pdf):
                x, ids = feature_block(part["features"], size), part[ROW_ID].to_numpy()
                for tree, nodes in open_.items():
                    mine = np.flatnonzero(in_sample(ids, tree, fraction, seed))
                    at = cuts.route(tree, x[mine])
                    order = np.argsort(at, kind="stable")
                    here, first = np.unique(at[order], return_index=True)
                    for node, rows in zip(here.tolist(), np.split(mine[order], first[1:])):
                        if node not in nodes:
                            continue
                        some = x[np.ix_(rows, drawn[tree, node])]
                        low, high = some.min(axis=0), some.max(axis=0)
                        if (tree, node) in found:
                            old = found[tree, node]
                            old[0] += len(rows)
                            np.minimum(old[1], low, out=old[1])
                            np.maximum(old[2], high, out=old[2])
                        else:
                            found[tree, node] = [len(rows), low, high]
        for (tree, node), (n, low, high) in found.items():
            yield pd.DataFrame({"tree": tree, "node": node, "j": np.arange(len(low)), "n": n, "low": low, "high": high})

    return run


def grow_top(rows: DataFrame, size: int, trees: int, fraction: float, n_rows: int, seed: int, task_rows: int) -> TopLevels:
    """Cuts of all nodes with more than ``task_rows`` rows."""
    spark = rows.sparkSession
    depth = max_depth(n_rows, fraction)
    cuts, leaves, closed = [], [], []
    if n_rows <= task_rows:
        return TopLevels(_frame([]), _frame([]), _frame([(t, 1, -1, 0.0, 0) for t in range(trees)]))
    open_ = {(t, 1): 0 for t in range(trees)}
    while open_:
        by_tree: dict[int, dict[int, int]] = {}
        for (t, n), tries in open_.items():
            by_tree.setdefault(t, {})[n] = tries
        shared = spark.sparkContext.broadcast((Cuts(_frame(cuts)), by_tree))

        def run(batches, shared=shared):
            known, nodes = shared.value
            return _report(known, nodes, size, fraction, seed)(batches)

        reports = rows.mapInPandas(run, "tree int, node bigint, j int, n bigint, low double, high double")
        ranges = reports.groupBy("tree", "node", "j").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
        )
        varying = F.when(F.col("high") > F.col("low"), F.struct("j", "low", "high"))
        # One row per open node: its rows, and the first drawn feature that varies in it.
        found = ranges.groupBy("tree", "node").agg(F.max("n").alias("n"), F.min(varying).alias("v")).collect()
        still = {}
        for r in found:
            t, node, n = r["tree"], r["node"], r["n"]
            level, tries = node.bit_length() - 1, open_[t, node]
            if n <= task_rows:
                closed.append((t, node, -1, 0.0, n))
            elif level >= depth:
                leaves.append((t, node, -1, 0.0, n))
            elif r["v"] is None:
                if DRAWN * (4 ** (tries + 1) - 1) // 3 >= size:
                    leaves.append((t, node, -1, 0.0, n))
                else:
                    still[t, node] = tries + 1
            else:
                feature = int(drawn_features(seed, t, node, size, tries)[r["v"]["j"]])
                low, high = r["v"]["low"], r["v"]["high"]
                cut = float(np.random.default_rng([seed, t, node, 1]).uniform(low, high))
                cuts.append((t, node, feature, low if cut >= high else cut, n))
                still[t, 2 * node], still[t, 2 * node + 1] = 0, 0
        open_ = still
    return TopLevels(_frame(cuts), _frame(leaves), _frame(closed))


def max_depth(n_rows: int, fraction: float) -> int:
    return max(1, math.ceil(math.log2(max(n_rows * fraction, 2))))


def grow_branches(rows: DataFrame, top: TopLevels, size: int, fraction: float, n_rows: int, seed: int) -> DataFrame:
    """Nodes below the closed nodes, each branch grown in a task of its own."""
    from logloom.models.iforest import grow_tree

    spark, depth = rows.sparkSession, max_depth(n_rows, fraction)
    closed = {int(t): part["node"].to_numpy() for t, part in top.closed.groupby("tree")}
    shared = spark.sparkContext.broadcast((Cuts(top.cuts), closed))
    kind = rows.schema["features"].dataType.simpleString()

    def place(batches):
        cuts, wanted = shared.value
        for pdf in batches:
            for part in chunks(pdf):
                x, ids = feature_block(part["features"], size), part[ROW_ID].to_numpy()
                trees_, nodes, at = [], [], []
                for tree, ends in wanted.items():
                    mine = np.flatnonzero(in_sample(ids, tree, fraction, seed))
                    where = cuts.route(tree, x[mine])
                    kept = np.isin(where, ends)
                    trees_.append(np.full(int(kept.sum()), tree))
                    nodes.append(where[kept])
                    at.append(mine[kept])
                rows_ = np.concatenate([np.zeros(0, np.int64), *at])
                for i in range(0, len(rows_), 5000):
                    some = slice(i, i + 5000)
                    yield pd.DataFrame(
                        {
                            "tree": np.concatenate(trees_)[some],
                            "root": np.concatenate(nodes)[some],
                            "features": part["features"].iloc[rows_[some]].to_list(),
                        }
                    )

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, root = int(pdf["tree"].iloc[0]), int(pdf["root"].iloc[0])
        level = root.bit_length() - 1
        x = feature_block(pdf["features"], size)
        nodes = grow_tree(x, np.random.default_rng([seed, tree, root, 2]), max(0, depth - level))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
        out["depth"] += level
        return out.assign(tree=tree, root=root)[[c.split()[0] for c in BRANCHES.split(", ")]]

    placed = rows.mapInPandas(place, f"tree int, root bigint, features {kind}")
    return placed.groupBy("tree", "root").applyInPandas(grow, BRANCHES)


def grow_forest(
    df: DataFrame, size: int, trees: int, fraction: float, n_rows: int, seed: int, task_rows: int = TASK_ROWS
) -> tuple[TopLevels, DataFrame]:
    """Cuts near the roots, and the written table of all branches below them."""
    ship_package(df.sparkSession)
    rows = df.select(ROW_ID, "features")
    top = grow_top(rows, size, trees, fraction, n_rows, seed, task_rows)
    return top, materialize(grow_branches(rows, top, size, fraction, n_rows, seed), "branches")


def whole_nodes(top: TopLevels, branches: pd.DataFrame) -> pd.DataFrame:
    """One node table out of both parts, nodes numbered anew in every tree."""
    upper = pd.concat([top.cuts, top.leaves], ignore_index=True)
    level = np.floor(np.log2(upper["node"].to_numpy().clip(min=1))).astype(int) if len(upper) else []
    upper = pd.DataFrame(
        {
            "tree": upper["tree"], "root": upper["node"], "node": 0, "feature": upper["feature"],
            "threshold": upper["threshold"], "left": -1, "right": -1, "size": upper["size"], "depth": level,
        }
    )
    parts = [p for p in (upper, branches) if len(p)]
    table = pd.concat(parts, ignore_index=True)
    table = table.sort_values(["tree", "root", "node"], ignore_index=True)
    first = table.groupby("tree")["tree"].transform("size").groupby(table["tree"]).cumcount()
    index = pd.MultiIndex.from_frame(table[["tree", "root", "node"]])
    inner = table["feature"].to_numpy() >= 0
    # A cut near the root has no children in its own branch: they are the starts of branches 2 i and 2 i + 1.
    far = inner & (table["left"].to_numpy() < 0)
    out = table.assign(node=first.to_numpy())
    for side, step in (("left", 0), ("right", 1)):
        root = np.where(far, 2 * table["root"].to_numpy() + step, table["root"].to_numpy())
        child = np.where(far, 0, table[side].to_numpy())
        wanted = pd.MultiIndex.from_arrays([table["tree"], root, child])
        at = index.get_indexer(wanted)
        out[side] = np.where(inner, first.to_numpy()[at], -1)
    return out.drop(columns="root").assign(param_id=0)


PACKED = (
    "tree int, root bigint, feature array<int>, threshold array<double>, left array<int>, right array<int>, path array<double>"
)


def _packed(pdf: pd.DataFrame) -> pd.DataFrame:
    """A branch as one row."""
    from logloom.models.iforest import average_path

    pdf = pdf.sort_values("node")
    path = pdf["depth"].to_numpy() + average_path(pdf["size"].to_numpy())
    row = {"tree": int(pdf["tree"].iloc[0]), "root": int(pdf["root"].iloc[0]), "path": path.tolist()}
    row |= {c: pdf[c].tolist() for c in ("feature", "threshold", "left", "right")}
    return pd.DataFrame([row])[[c.split()[0] for c in PACKED.split(", ")]]


def _descend(branch: dict, x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Path lengths of ``rows`` of a block, or all."""
    feature, cut, left, right, path = (np.asarray(branch[c]) for c in ("feature", "threshold", "left", "right", "path"))
    rows = np.arange(len(x)) if rows is None else rows
    at, moving = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while len(moving):
        moving = moving[feature[at[moving]] >= 0]
        here = at[moving]
        at[moving] = np.where(x[rows[moving], feature[here]] > cut[here], right[here], left[here])
    return path[at]


def task_holds(n_rows: int, size: int) -> bool:
    return n_rows * size * 8 <= HELD_BYTES


def _labels(spark, n: int) -> list[int]:
    """A number for each of ``n`` partitions that it is hashed to."""
    at = spark.range(64 * n).select(F.col("id").cast("int").alias("share"))
    at = at.groupBy(F.pmod(F.hash("share"), F.lit(n))).agg(F.min("share").alias("share"))
    return sorted(r["share"] for r in at.collect())


def _known(top: TopLevels) -> dict[tuple[int, int], float]:
    """Path lengths of the leaves near the roots."""
    from logloom.models.iforest import average_path

    return {
        (int(t), int(n)): (int(n).bit_length() - 1) + float(average_path(np.array([s]))[0])
        for t, n, s in zip(top.leaves["tree"], top.leaves["node"], top.leaves["size"])
    }


def grow_together(
    df: DataFrame, size: int, counts: list[int], fractions: list[float], n_rows: int, seed: int, task_rows: int = TASK_ROWS
) -> dict[float, tuple[TopLevels, DataFrame, DataFrame]]:
    """For each fraction the cuts near the roots, all branches, and (row_id, s0, s1, ...) as ``table_lengths`` has it for these rows.

    For tables that a task can hold: all rows go to ``SHARES`` tasks, not once per tree, and each grows its trees of
    all fractions and sends the rows down them.  Path lengths are added up in the order of the shares.
    """
    from logloom.models.iforest import average_path, grow_tree

    spark = df.sparkSession
    ship_package(spark)
    trees = counts[-1]
    rows = materialize(df.select(F.monotonically_increasing_id().alias("_n"), ROW_ID, "features").repartition(SHARES), "iforest-rows")
    tops = [grow_top(rows.select(ROW_ID, "features"), size, trees, f, n_rows, seed, task_rows) for f in fractions]
    labels = _labels(spark, min(trees, SHARES))
    plans = []
    for f, top in zip(fractions, tops):
        closed = {int(t): part["node"].tolist() for t, part in top.closed.groupby("tree")}
        plans.append((f, max_depth(n_rows, f), Cuts(top.cuts), closed, _known(top)))
    shared = spark.sparkContext.broadcast((labels, plans))
    names = [c.split()[0] for c in BRANCHES.split(", ")]
    sums = [f"s{p}_{i}" for p in range(len(fractions)) for i in range(len(counts))]

    def grow(share: int, x: np.ndarray, ids: np.ndarray, numbers: np.ndarray):
        labels_, plans_ = shared.value
        total = np.zeros((len(fractions), len(counts), len(x)))
        for p, (fraction, depth, cuts, closed, leaves) in enumerate(plans_):
            for tree in range(labels_.index(share), trees, len(labels_)):
                at, mine = cuts.route(tree, x), in_sample(ids, tree, fraction, seed)
                length = np.zeros(len(x))
                for root in closed.get(tree, []):
                    here = np.flatnonzero(at == root)
                    sample = here[mine[here]]
                    if len(sample) == 0:
                        continue
                    level = root.bit_length() - 1
                    nodes = grow_tree(x, np.random.default_rng([seed, tree, root, 2]), max(0, depth - level), sample)
                    out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"])
                    out["depth"] += level
                    branch = out.to_dict("series") | {"path": out["depth"].to_numpy() + average_path(out["size"].to_numpy())}
                    length[here] = _descend(branch, x, here)
                    yield out.assign(tree=tree, root=root, param=p)[["param", *names]]
                for (t, node), path in leaves.items():
                    if t == tree:
                        length[at == node] = path
                for i, n in enumerate(counts):
                    if tree < n:
                        total[p, i] += length
        flat = total.reshape(-1, len(x))
        for i in range(0, len(x), 10_000):
            some = slice(i, i + 10_000)
            yield pd.DataFrame({"_n": numbers[some], "share": share} | dict(zip(sums, flat[:, some])))

    def run(batches):
        held: dict[int, list] = {}
        for pdf in batches:
            for share, part in pdf.groupby("share"):
                for some in chunks(part):
                    held.setdefault(int(share), []).append(
                        (feature_block(some["features"], size), some[ROW_ID].to_numpy().astype(np.int64), some["_n"].to_numpy())
                    )
        for share in sorted(held):
            x, ids, numbers = zip(*held.pop(share))
            block = np.empty((sum(map(len, x)), x[0].shape[1]), order="F")
            np.concatenate(x, out=block)
            del x
            for out in grow(share, block, np.concatenate(ids), np.concatenate(numbers)):
                yield out.reindex(columns=kept)

    dealt = rows.withColumn("share", F.explode(F.array(*map(F.lit, labels)))).repartition(len(labels), "share")
    kind = f"param int, {BRANCHES}, _n bigint, share int, " + ", ".join(f"{c} double" for c in sums)
    kept = [c.split()[0] for c in kind.split(", ")]
    made = materialize(dealt.mapInPandas(run, kind), "forests")
    each = F.array_sort(F.collect_list(F.struct("share", F.array(*sums).alias("s"))))
    total = made.where("_n IS NOT NULL").groupBy("_n").agg(each.alias("e"))
    start = F.array_repeat(F.lit(0.0), len(sums))
    total = total.select("_n", F.aggregate("e", start, lambda a, e: F.zip_with(a, e["s"], lambda u, v: u + v)).alias("s"))
    total = materialize(rows.select("_n", ROW_ID).join(total, "_n"), "lengths")
    out = {}
    for p, (f, top) in enumerate(zip(fractions, tops)):
        lengths = [F.col("s")[p * len(counts) + i].alias(f"s{i}") for i in range(len(counts))]
        out[f] = (top, made.where(F.col("param") == p).select(*names), total.select(ROW_ID, *lengths))
    return out


def table_lengths(df: DataFrame, top: TopLevels, branches: DataFrame, size: int, counts: list[int], n_rows: int) -> DataFrame:
    """(row_id, s0, s1, ...): summed path lengths of the first ``counts[i]`` trees, branches left in their table.

    A row goes down the cuts near the roots where it is, then once per tree to the branch it came to.
    Rows of a branch are read behind it as a stream; where more rows are scored than were trained on, a
    branch is copied and its rows are dealt to the copies.
    """
    from logloom.models.iforest import average_path

    spark = df.sparkSession
    ship_package(spark)
    trees = max(counts)
    known = _known(top)
    shared = spark.sparkContext.broadcast((Cuts(top.cuts), known))
    kind = df.schema["features"].dataType.simpleString()
    rows = df.select(ROW_ID, "features")
    copies = max(1, -(-rows.count() // max(1, n_rows)))

    def place(batches):
        cuts, leaves = shared.value
        for pdf in batches:
            for part in chunks(pdf, 256):
                x, features = feature_block(part["features"], size), part["features"].to_list()
                for tree in range(trees):
                    roots = cuts.route(tree, x)
                    done = [leaves.get((tree, n)) for n in roots.tolist()]
                    yield pd.DataFrame(
                        {
                            ROW_ID: part[ROW_ID].to_numpy(),
                            "tree": tree,
                            "root": roots,
                            "length": pd.Series(done, dtype=float),
                            "features": [f if d is None else None for f, d in zip(features, done)],
                        }
                    )

    placed = rows.mapInPandas(place, f"{ROW_ID} bigint, tree int, root bigint, length double, features {kind}")
    open_ = placed.where("length IS NULL").withColumn("copy", F.pmod(F.xxhash64(ROW_ID), F.lit(copies)).cast("int"))
    packed = branches.groupBy("tree", "root").applyInPandas(_packed, PACKED)
    packed = packed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    both = packed.unionByName(open_.drop("length"), allowMissingColumns=True)
    met = both.repartition("tree", "root", "copy").sortWithinPartitions("tree", "root", "copy", F.col(ROW_ID).asc_nulls_first())

    def lengths(batches):
        branch = None
        for pdf in batches:
            starts = np.flatnonzero(pdf[ROW_ID].isna().to_numpy())
            cuts = np.unique(np.concatenate([[0], starts, starts + 1, [len(pdf)]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = pdf.iloc[a:b]
                if pd.isna(part[ROW_ID].iloc[0]):
                    branch = part.iloc[0].to_dict()
                    continue
                for some in chunks(part):
                    x = feature_block(some["features"], size)
                    yield pd.DataFrame(
                        {ROW_ID: some[ROW_ID].astype("int64"), "tree": some["tree"], "length": _descend(branch, x)}
                    )

    below = met.mapInPandas(lengths, f"{ROW_ID} bigint, tree int, length double")
    every = below.unionByName(placed.where("length IS NOT NULL").select(ROW_ID, "tree", "length"))
    return every.groupBy(ROW_ID).agg(*[F.sum(F.when(F.col("tree") < n, F.col("length"))).alias(f"s{i}") for i, n in enumerate(counts)])
