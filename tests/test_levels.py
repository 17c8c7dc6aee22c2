"""Trees over fractions of a table: grown near the root by reports, below in tasks, scored from tables."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom.models import iforest, levels
from logloom.models.registry import Detector, train
from logloom.operators.tfidf import sparse_rows


def matrix(spark, n=300, d=4, hot=0):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, d)), 1)
    x[:hot] = x[0]
    x[:, -1] = 7.0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>"), x


def forest(df, trees=6, fraction=1.0, task_rows=25, **kw):
    return iforest.IsolationForest.fit(df, n_estimators=trees, max_samples=fraction, task_rows=task_rows, **kw)


@pytest.mark.parametrize("fraction, task_rows", [(1.0, 25), (0.5, 25), (0.5, 1000), (0.75, 1)])
def test_trees_hold_their_samples(spark, fraction, task_rows):
    df, x = matrix(spark)
    model = forest(df.repartition(5), fraction=fraction, task_rows=task_rows, calibrate=False)
    depth = levels.max_depth(len(x), fraction)
    for t, tree in model.nodes.groupby("tree"):
        tree = tree.set_index("node")
        mine = np.flatnonzero(levels.in_sample(np.arange(len(x)), int(t), fraction, 42))
        assert abs(len(mine) - fraction * len(x)) <= (0 if fraction == 1.0 else 60)
        seen, open_ = 0, [(0, mine)]
        while open_:
            at, rows = open_.pop()
            node = tree.loc[at]
            seen += 1
            assert node["size"] == len(rows)
            if node["feature"] < 0:
                assert len(rows) <= 1 or node["depth"] == depth or len(np.unique(x[rows], axis=0)) == 1
                continue
            left = x[rows, int(node["feature"])] <= node["threshold"]
            assert left.any() and not left.all() and node["depth"] < depth
            open_ += [(int(node["left"]), rows[left]), (int(node["right"]), rows[~left])]
        assert seen == len(tree)


def test_partitions_change_nothing(spark):
    df, _ = matrix(spark)
    a, b = (forest(d, fraction=0.75, calibrate=False).nodes for d in (df.repartition(2), df.repartition(7, "row_id")))
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_equal_rows_are_a_leaf_near_the_root(spark):
    df, _ = matrix(spark, hot=120)
    nodes = forest(df, calibrate=False).nodes
    assert nodes.loc[nodes["feature"] < 0, "size"].groupby(nodes["tree"]).max().ge(120).all()


@pytest.mark.parametrize("copies", [1, 3])
def test_scores_from_tables(spark, copies):
    """Nodes left in tables give the scores of collected nodes, for more rows than were trained on too."""
    df, _ = matrix(spark, hot=60)
    small, large = forest(df, fraction=0.75), forest(df, fraction=0.75, max_nodes=0)
    assert small.nodes is not None and large.nodes is None
    rows = df.select("*", F.explode(F.array(*map(F.lit, range(copies)))).alias("k"))
    rows = rows.select((F.col("row_id") + 1000 * F.col("k")).alias("row_id"), "features")
    want = {r.row_id: (r.score, r.anomaly_label) for r in small.score(rows).collect()}
    got = {r.row_id: (r.score, r.anomaly_label) for r in large.score(rows).collect()}
    assert got.keys() == want.keys() and len(got) == 300 * copies
    for k, (score, label) in want.items():
        assert got[k] == (pytest.approx(score), label)


def test_sparse_rows_and_a_saved_table_model(spark, tmp_path):
    df, _ = matrix(spark)
    cells = df.select("row_id", F.posexplode("features").alias("term_index", "weight"))
    sparse = sparse_rows(cells).select("row_id", F.struct("indices", "values").alias("features"))
    dense = {r.row_id: r.score for r in forest(df, size=4, max_nodes=0).score(df).collect()}
    detector = train(sparse, n_estimators=6, max_samples=1.0, contamination="auto", size=4, task_rows=25, max_nodes=0)
    detector.save(spark, str(tmp_path))
    got = {r.row_id: r.score for r in Detector.load(spark, str(tmp_path)).model.score(sparse).collect()}
    assert got == pytest.approx(dense)


def test_tuning_uses_first_trees_of_one_forest(spark):
    df, _ = matrix(spark, n=200)
    for max_nodes in (iforest.MAX_NODES, 0):
        model = iforest.tune(df, n_estimators=(5, 10), max_samples=(0.5, 1.0), task_rows=40, max_nodes=max_nodes)
        assert [(r["n_estimators"], r["max_samples"]) for r in model.tuning] == [(5, 0.5), (10, 0.5), (5, 1.0), (10, 1.0)]
        best = max(model.tuning, key=lambda r: r["separation_score"])
        assert model.params["n_estimators"] == best["n_estimators"]
        alone = forest(df, trees=best["n_estimators"], fraction=best["max_samples"], task_rows=40)
        want = {r.row_id: r.score for r in alone.score(df).collect()}
        assert {r.row_id: r.score for r in model.score(df).collect()} == pytest.approx(want)
        assert {r.row_id: r.score for r in model.training_scores().collect()} == pytest.approx(want)
    assert iforest.tuning_table(spark, model).count() == 4


def test_fractions_out_of_range(spark):
    df, _ = matrix(spark, n=10)
    for wrong in (0.0, 1.5, -0.5):
        with pytest.raises(ValueError, match="max_samples"):
            forest(df, fraction=wrong)


def test_drawn_features_cover_all():
    for size in (3, 16, 17, 100, 1000):
        parts = [levels.drawn_features(1, 2, 3, size, k) for k in range(6)]
        assert sorted(np.concatenate(parts)) == list(range(size))


def test_memory_of_the_largest_collected_forest():
    """The driver turns ``MAX_NODES`` nodes into the table and the arrays it broadcasts within 400 MB."""
    trees = 100
    k = np.arange(iforest.MAX_NODES // trees, dtype=np.int32)
    inner = 2 * k + 2 < len(k)
    one = {
        "root": 1, "node": k, "feature": np.where(inner, k % 8, -1), "threshold": 0.5, "left": np.where(inner, 2 * k + 1, -1),
        "right": np.where(inner, 2 * k + 2, -1), "size": 1, "depth": np.floor(np.log2(k + 1)).astype(np.int32),
    }
    branches = pd.concat([pd.DataFrame(one).assign(tree=t) for t in range(trees)], ignore_index=True)
    none = levels._frame([])
    tracemalloc.start()
    try:
        iforest.PackedForest(levels.whole_nodes(levels.TopLevels(none, none, none), branches), 8, 256)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 400 * 2**20


def test_tuning_moves_no_row_once_per_tree(spark, monkeypatch):
    """Where a task can hold the table, forests that stay in tables are grown and scored in shares of trees."""
    df, _ = matrix(spark, n=200, hot=30)
    kw = {"n_estimators": (5, 30), "max_samples": (0.5, 1.0), "task_rows": 40}
    want = iforest.tune(df, **kw, max_nodes=10**6)
    single = {r.row_id: r.raw for r in want.training_raw.collect()}

    def moved(*a, **k):
        raise AssertionError("a row for every tree")

    monkeypatch.setattr(levels, "grow_branches", moved)
    monkeypatch.setattr(levels, "table_lengths", moved)
    got = iforest.tune(df, **kw, max_nodes=0)
    assert got.nodes is None and want.nodes is not None
    for a, b in zip(want.tuning, got.tuning, strict=True):
        assert (a["n_estimators"], a["max_samples"]) == (b["n_estimators"], b["max_samples"])
        for c in ("separation_score", "score_std", "anomaly_ratio"):
            assert b[c] == pytest.approx(a[c])
    assert {r.row_id: r.raw for r in got.training_raw.collect()} == pytest.approx(single)
    nodes = levels.whole_nodes(got.top, got.branches.toPandas())
    nodes = nodes[nodes["tree"] < got.params["n_estimators"]]
    columns = ["tree", "node", "feature", "threshold", "left", "right", "size", "depth"]
    a, b = (x.sort_values(["tree", "node"], ignore_index=True)[columns] for x in (want.nodes, nodes))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_lengths_of_rows_that_repeat_or_have_no_key(spark):
    df, x = matrix(spark, n=120)
    rows = df.select(F.when(F.col("row_id") < 100, F.floor(F.col("row_id") / 2)).alias("row_id"), "features")
    top, branches, sums = levels.grow_together(rows, 4, [3, 8], [0.5, 1.0], 120, 42, 30)[1.0]
    got = sums.collect()
    assert len(got) == 120 and sum(r.row_id is None for r in got) == 20
    want = {r.row_id: (r.s0, r.s1) for r in levels.grow_together(df, 4, [3, 8], [0.5, 1.0], 120, 42, 30)[1.0][2].collect()}
    np.testing.assert_allclose(sorted((r.s0, r.s1) for r in got), sorted(want.values()))


def test_one_feature_is_read_where_all_vary():
    """The trees are those of reading every feature of every node."""

    def plain(x, rng, max_depth):
        nodes, stack = [], [(np.arange(len(x)), 0, None, None)]
        while stack:
            rows, depth, parent, side = stack.pop()
            me = len(nodes)
            nodes.append([me, -1, 0.0, -1, -1, len(rows), depth])
            if parent is not None:
                nodes[parent][side] = me
            if depth >= max_depth or len(rows) <= 1:
                continue
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            varying = np.flatnonzero(high > low)
            if len(varying) == 0:
                continue
            f = int(varying[rng.integers(len(varying))])
            cut = float(rng.uniform(low[f], high[f]))
            cut = float(low[f]) if cut >= high[f] else cut
            left = x[rows, f] <= cut
            nodes[me][1], nodes[me][2] = f, cut
            stack += [(rows[~left], depth + 1, me, 4), (rows[left], depth + 1, me, 3)]
        return [tuple(n) for n in nodes]

    rng = np.random.default_rng(1)
    smooth = rng.normal(size=(300, 5))
    for x in (smooth, np.round(smooth, 1), np.repeat(smooth[:40], 5, axis=0), np.zeros((9, 3)), np.where(smooth > 1.5, np.nan, smooth)):
        want = plain(x, np.random.default_rng(3), 9)
        for block in (x, np.asfortranarray(x)):
            assert str(iforest.grow_tree(block, np.random.default_rng(3), 9)) == str(want)
        some = np.arange(0, len(x), 2)
        assert str(iforest.grow_tree(x, np.random.default_rng(3), 9, some)) == str(plain(x[some], np.random.default_rng(3), 9))
