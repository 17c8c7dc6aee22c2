"""Isolation forest (Liu, Ting and Zhou, 2008).

Samples of a given number of rows: a hash of the row key picks a uniform pool of rows, a second hash per
tree picks that tree's sample from the pool, and each tree is grown in its own
task.  The pool follows the number of trees and their samples, not the table, and so do
the nodes, which can be collected and broadcast.  Scoring is one pass over the rows.

Samples that are a fraction of the table are grown level by level (levels.py).  Their nodes
follow the table: up to ``MAX_NODES`` they are collected as above, beyond they stay a table, and
scoring brings rows and branches together by (tree, branch).  Tuning scores the rows it grows from, so
where a task can hold the table, every task grows and scores a share of the trees.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.models import levels
from logloom.models.matrix import chunks, feature_block, sparse_blocks, struct_frame
from logloom.operators.ordered import exact_percentiles
from logloom.schema import ROW_ID
from logloom.session import materialize, ship_package

# The published sub-sample size and the defaults of a forest.
AUTO_SAMPLES = 256
DEFAULTS = {
    "n_estimators": 200,
    "contamination": "auto",
    "max_samples": "auto",
    "random_state": 42,
}
AUTO_OFFSET = -0.5

# The pool trees are sampled from holds this many times the rows that all trees draw, if there are so many.
POOL_FACTOR = 4
# Rows that descend together: their block and its nodes stay in a core's cache.
DESCENT_ROWS = 128
# Nodes that are collected and broadcast; more stay in a table.
MAX_NODES = 400_000
# Rows of a node that are looked at before all of them are.
SHOWING_ROWS = 8
_MODULUS = 1 << 30

NODES = T.StructType(
    [
        T.StructField("param_id", T.IntegerType()),
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)

_TOP_NODES = "tree bigint, node bigint, feature bigint, threshold double, size bigint"


def average_path(n) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def path_norm(psi: int) -> float:
    return float(average_path(np.array([psi]))[0]) or 1.0


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int, rows: np.ndarray | None = None) -> list[tuple]:
    """Nodes ``(node, feature, threshold, left, right, size, depth)`` of one tree over ``rows`` of a block, or all.

    A node draws among the features that vary in it.  Where a few of its rows show that all do, only the drawn
    one is read.
    """
    nodes: list[list] = []
    stack = [(np.arange(len(x)) if rows is None else rows, 0, None, None)]
    ordered = not np.isnan(x).any()
    while stack:
        rows, depth, parent, side = stack.pop()
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(rows), depth])
        if parent is not None:
            nodes[parent][side] = me
        if depth >= max_depth or len(rows) <= 1:
            continue
        if ordered and (x[rows[1:SHOWING_ROWS]] != x[rows[0]]).any(axis=0).all():
            f = int(rng.integers(x.shape[1]))
            values = x[rows, f]
            low, high = values.min(), values.max()
        else:
            part = x[rows]
            lows, highs = part.min(axis=0), part.max(axis=0)
            varying = np.flatnonzero(highs > lows)
            if len(varying) == 0:
                continue
            f = int(varying[rng.integers(len(varying))])
            low, high, values = lows[f], highs[f], part[:, f]
        cut = float(rng.uniform(low, high))
        if cut >= high:
            cut = float(low)
        left = values <= cut
        nodes[me][1], nodes[me][2] = f, cut
        stack.append((rows[~left], depth + 1, me, 4))
        stack.append((rows[left], depth + 1, me, 3))
    return [tuple(n) for n in nodes]


def sample_size(max_samples, n_rows: int) -> int:
    """Rows of a tree's sample; a fraction is one of the whole table."""
    if max_samples == "auto":
        return max(1, min(AUTO_SAMPLES, n_rows))
    if isinstance(max_samples, float):
        if not 0.0 < max_samples <= 1.0:
            raise ValueError("a fractional max_samples lies above 0 and up to 1")
        return max(1, int(max_samples * n_rows))
    return max(1, min(int(max_samples), n_rows))


def _grow_forest(df: DataFrame, n_rows: int, size: int, trees: int, psi: int, seed: int) -> DataFrame:
    """Nodes of a forest whose trees have samples of ``psi`` rows."""
    ship_package(df.sparkSession)
    share = min(1.0, POOL_FACTOR * trees * psi / n_rows)
    pool = df.select(ROW_ID, "features").where(
        F.pmod(F.xxhash64(F.lit(seed), ROW_ID), F.lit(_MODULUS)) < int(_MODULUS * share)
    )
    expected = n_rows * share
    # Room for the spread of a binomial count, so that a tree is never short.
    want = psi + 6.0 * math.sqrt(psi) + 8.0
    limit = _MODULUS if expected * 0.9 <= want else int(_MODULUS * want / (expected * 0.9))
    drawn = F.explode(_candidates(0, trees, psi, limit, seed)).alias("c")
    hits = pool.select(ROW_ID, "features", drawn).select(ROW_ID, "features", "c.*")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pid, tree, psi = (int(pdf[c].iloc[0]) for c in ("param_id", "tree", "psi"))
        mine = pdf.sort_values(["draw", ROW_ID]).head(psi)
        x = feature_block(mine["features"], size)
        depth = max(1, math.ceil(math.log2(max(len(x), 2))))
        rng = np.random.default_rng([seed, tree, psi])
        rows = grow_tree(x, rng, depth)
        return pd.DataFrame([(pid, tree, *r) for r in rows], columns=NODES.names)

    return hits.groupBy("param_id", "tree").applyInPandas(build, NODES)


def _candidates(pid: int, trees: int, psi: int, limit: int, seed: int):
    """The trees a row may belong to, with its draw for each of them.

    Draws are compared before anything is built: of many trees a row belongs to few.
    """

    def draw(t):
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(psi), t, F.col(ROW_ID)), F.lit(_MODULUS))

    def entry(t):
        return F.struct(
            F.lit(pid).alias("param_id"), t.alias("tree"), F.lit(psi).alias("psi"), draw(t).alias("draw")
        )

    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < limit)
    return F.transform(mine, entry)


class PackedForest:
    """All nodes of a forest in flat arrays, for vectorised descent.

    A leaf is its own child, so every row takes the same number of steps.
    """

    def __init__(self, nodes: pd.DataFrame, size: int, psi: int) -> None:
        nodes = nodes.sort_values(["tree", "node"])
        used = np.sort(nodes.loc[nodes["feature"] >= 0, "feature"].unique()).astype(int)
        self.positions = np.full(size, -1, dtype=np.int64)
        self.positions[used] = np.arange(len(used))
        self.width = max(1, len(used))
        self.size = size
        self.depth = int(nodes["depth"].max())
        self.norm = path_norm(psi)

        counts = nodes.groupby("tree", sort=True).size().to_numpy()
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        first = np.repeat(starts, counts)
        me = np.arange(len(nodes))
        feature = nodes["feature"].to_numpy()
        inner = feature >= 0
        self.roots = starts
        self.feature = np.where(inner, self.positions[np.where(inner, feature, 0)], 0)
        self.threshold = np.where(inner, nodes["threshold"].to_numpy(), np.inf)
        self.child = np.empty(2 * len(nodes), dtype=np.int64)
        self.child[0::2] = np.where(inner, first + nodes["left"].to_numpy(), me)
        self.child[1::2] = np.where(inner, first + nodes["right"].to_numpy(), me)
        self.path = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2^(-E[h]/c): near 1 for isolated points."""
        return np.exp2(-self.lengths(x).mean(axis=1) / self.norm)

    def lengths(self, x: np.ndarray) -> np.ndarray:
        """Path length of every row in every tree."""
        flat, width = x.ravel(), x.shape[1]
        row = (np.arange(len(x)) * width)[:, None]
        node = np.tile(self.roots, (len(x), 1))
        for _ in range(self.depth):
            right = flat.take(row + self.feature.take(node)) > self.threshold.take(node)
            node = self.child.take(2 * node + right)
        return self.path.take(node)

    def blocks(self, col):
        if not isinstance(col, pd.DataFrame) and len(col) and isinstance(col.iloc[0], dict):
            col = struct_frame(col)
        if isinstance(col, pd.DataFrame):
            yield from sparse_blocks(col, self.width, self.positions, DESCENT_ROWS)
            return
        for c in chunks(col, DESCENT_ROWS):
            yield feature_block(c, self.size, positions=self.positions, width=self.width)

    def score_column(self, col) -> pd.Series:
        parts = [self.anomaly(x) for x in self.blocks(col)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))


def _score_expr(spark: SparkSession, forest: PackedForest, features: str = "features"):
    ship_package(spark)
    shared = spark.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def anomaly(col: pd.Series) -> pd.Series:
        return shared.value.score_column(col)

    @F.pandas_udf(T.DoubleType())
    def anomaly_struct(col: pd.DataFrame) -> pd.Series:
        return shared.value.score_column(col)

    return anomaly, anomaly_struct


@dataclass
class IsolationForest:
    """A fitted forest.

    ``nodes`` is the driver's copy of the node table.  A forest of more than ``MAX_NODES`` nodes
    has none, but the cuts near its roots (``top``) and a table of ``branches`` below them.
    """

    nodes: pd.DataFrame | None
    size: int
    psi: int
    params: dict
    offset: float = AUTO_OFFSET
    threshold: float | None = None
    score_min: float | None = None
    score_max: float | None = None
    n_rows: int = 0
    tuning: list[dict] = field(default_factory=list)
    top: levels.TopLevels | None = None
    branches: DataFrame | None = None
    training_raw: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def fit(
        cls, df: DataFrame, size: int | None = None, calibrate: bool = True, **params
    ) -> "IsolationForest":
        """Fit on ``(row_id, features)``.

        ``calibrate`` scores the training rows once for the contamination
        offset, the 5th percentile threshold and the score range.
        """
        settings = {**DEFAULTS, **params}
        n_rows = df.count()
        if n_rows == 0:
            raise ValueError("cannot fit a forest on an empty table")
        size = size or feature_size(df)
        model = cls._grow(df, n_rows, size, settings)
        if calibrate or settings["contamination"] != "auto":
            model._calibrate(model.raw_scores(df))
        return model

    @classmethod
    def _grow(cls, df: DataFrame, n_rows: int, size: int, settings: dict) -> "IsolationForest":
        trees, samples, seed = (settings[k] for k in ("n_estimators", "max_samples", "random_state"))
        psi = sample_size(samples, n_rows)
        if not isinstance(samples, float):
            nodes = _grow_forest(df, n_rows, size, trees, psi, seed).toPandas()
            return cls(nodes, size, psi, settings, n_rows=n_rows)
        top, branches = levels.grow_forest(
            df, size, trees, samples, n_rows, seed, settings.get("task_rows", levels.TASK_ROWS)
        )
        return cls._of_levels(top, branches, size, psi, settings, n_rows)

    @classmethod
    def _of_levels(cls, top, branches: DataFrame, size: int, psi: int, settings: dict, n_rows: int) -> "IsolationForest":
        """A forest out of both parts, collected if it has few nodes."""
        model = cls(None, size, psi, settings, n_rows=n_rows, top=top, branches=branches)
        if branches.count() + len(top.cuts) + len(top.leaves) <= settings.get("max_nodes", MAX_NODES):
            model.nodes, model.top, model.branches = levels.whole_nodes(top, branches.toPandas()), None, None
        return model

    def _calibrate(self, scored: DataFrame) -> None:
        """Offset, threshold and range from ``(row_id, raw)`` of the training rows, which are kept."""
        raw = materialize(scored.select(ROW_ID, "raw"), "iforest-scores")
        ends = raw.agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).first()
        c = self.params["contamination"]
        wanted = [0.05] if c == "auto" else sorted({0.05, float(c)})
        got = {r["p"]: r["percentile"] for r in exact_percentiles(raw, "raw", wanted).collect()}
        self.offset = AUTO_OFFSET if c == "auto" else got[float(c)]
        self.threshold = got[0.05] - self.offset
        self.score_min = ends["lo"] - self.offset
        self.score_max = ends["hi"] - self.offset
        self.training_raw = raw

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """Adds ``raw`` = -2^(-E[h]/c), before the offset."""
        spark = df.sparkSession
        if self.nodes is None:
            trees = self.params["n_estimators"]
            sums = levels.table_lengths(df, self.top, self.branches, self.size, [trees], self.n_rows)
            raw = -F.pow(F.lit(2.0), -F.col("s0") / trees / F.lit(path_norm(self.psi)))
            return df.join(sums.select(ROW_ID, raw.alias("raw")), ROW_ID)
        plain, struct = _score_expr(spark, PackedForest(self.nodes, self.size, self.psi))
        udf = struct if dict(df.dtypes)["features"].startswith("struct") else plain
        return df.withColumn("raw", -udf("features"))

    def score(self, df: DataFrame) -> DataFrame:
        """Replaces ``features`` by ``score`` (low = anomalous) and ``anomaly_label``."""
        return self._judged(self.raw_scores(df).drop("features"))

    def training_scores(self) -> DataFrame:
        """``(row_id, score, anomaly_label)`` of the rows the model was calibrated on, not computed again."""
        return self._judged(self.training_raw)

    def _judged(self, raw: DataFrame) -> DataFrame:
        scored = raw.withColumn("score", F.col("raw") - F.lit(self.offset)).drop("raw")
        return scored.withColumn("anomaly_label", F.when(F.col("score") < 0, -1).otherwise(1))

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        if self.nodes is not None:
            return {"nodes": spark.createDataFrame(self.nodes, NODES)}
        parts = {f"top_{n}": getattr(self.top, n) for n in ("cuts", "leaves", "closed")}
        return {"branches": self.branches} | {n: spark.createDataFrame(p, _TOP_NODES) for n, p in parts.items()}

    def meta(self) -> dict:
        return {
            "size": self.size,
            "psi": self.psi,
            "params": self.params,
            "offset": self.offset,
            "threshold": self.threshold,
            "score_min": self.score_min,
            "score_max": self.score_max,
            "n_rows": self.n_rows,
        }

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame], meta: dict) -> "IsolationForest":
        if "nodes" in tables:
            return cls(nodes=tables["nodes"].toPandas(), **meta)
        top = levels.TopLevels(*(tables[f"top_{n}"].toPandas() for n in ("cuts", "leaves", "closed")))
        return cls(nodes=None, top=top, branches=tables["branches"], **meta)

    def __repr__(self) -> str:
        return f"IsolationForest({json.dumps(self.params)}, psi={self.psi})"


def feature_size(df: DataFrame) -> int:
    if dict(df.dtypes)["features"].startswith("struct"):
        top = df.agg(F.max(F.array_max("features.indices")).alias("m")).first()["m"]
        return int(top or 0) + 1
    return int(df.agg(F.max(F.size("features")).alias("m")).first()["m"] or 0)


TUNING = "n_estimators int, max_samples string, separation_score double, score_std double, anomaly_ratio double"


def tune(
    df: DataFrame,
    n_estimators: tuple = (100, 200, 300),
    max_samples: tuple = (0.5, 0.75, 1.0),
    percentile: float = 5.0,
    size: int | None = None,
    random_state: int = 42,
    **params,
) -> IsolationForest:
    """Grid search; the best setting separates the lowest scores the most.

    Trees depend on the seed and the sample, not on how many there are, so one forest is grown for each
    sample size, and the settings with fewer trees are the first trees of it.  One pass scores
    all settings of a sample size, or of all sample sizes where a task can hold the table.  The best setting is kept as it is, nothing is fitted again;
    ``tuning`` has the figures of every setting.
    """
    n_rows = df.count()
    if n_rows == 0:
        raise ValueError("cannot tune a forest on an empty table")
    size = size or feature_size(df)
    counts = sorted(set(n_estimators))
    settings = {**DEFAULTS, **params, "n_estimators": counts[-1], "random_state": random_state}
    together = _grow_together(df, n_rows, size, counts, max_samples, settings)
    best, results = None, []
    for samples in max_samples:
        mine = {**settings, "max_samples": samples}
        if samples in together:
            top, branches, sums = together[samples]
            forest = IsolationForest._of_levels(top, branches, size, sample_size(samples, n_rows), mine, n_rows)
        else:
            forest, sums = IsolationForest._grow(df, n_rows, size, mine), None
        scored = materialize(_prefix_scores(df, forest, counts, sums), "iforest-tuning")
        for i, trees in enumerate(counts):
            figures = _separation(scored, f"s{i}", percentile)
            results.append({"n_estimators": trees, "max_samples": samples, **figures})
            if best is None or figures["separation_score"] > best[0]["separation_score"]:
                best = (results[-1], forest, scored.select(ROW_ID, F.col(f"s{i}").alias("raw")))
    chosen, model, raw = best
    model.params = {**model.params, "n_estimators": chosen["n_estimators"]}
    if model.nodes is not None:
        model.nodes = model.nodes[model.nodes["tree"] < chosen["n_estimators"]].reset_index(drop=True)
    model._calibrate(raw)
    model.tuning = results
    return model


def tuning_table(spark: SparkSession, model) -> DataFrame:
    """The figures of every setting that ``tune`` tried."""
    rows = [(r["n_estimators"], str(r["max_samples"]), r["separation_score"], r["score_std"], r["anomaly_ratio"]) for r in model.tuning]
    return spark.createDataFrame(rows, TUNING)


def _grow_together(df: DataFrame, n_rows: int, size: int, counts: list[int], max_samples: tuple, settings: dict) -> dict:
    """(top, branches, summed path lengths) of each fraction, where nodes may be too many to collect and a task can hold the table."""
    trees, most = counts[-1], settings.get("max_nodes", MAX_NODES)
    fractions = [s for s in dict.fromkeys(max_samples) if isinstance(s, float)]
    psi = max([sample_size(s, n_rows) for s in fractions], default=0)
    if 2 * psi * trees <= most or not levels.task_holds(n_rows, size):
        return {}
    task_rows = settings.get("task_rows", levels.TASK_ROWS)
    return levels.grow_together(df, size, counts, fractions, n_rows, settings["random_state"], task_rows)


def _prefix_scores(df: DataFrame, forest: IsolationForest, counts: list[int], sums: DataFrame | None = None) -> DataFrame:
    """``row_id`` and the raw score by the first ``counts[i]`` trees as ``s<i>``; ``sums``: its path lengths, if known."""
    norm = path_norm(forest.psi)
    if forest.nodes is None:
        if sums is None:
            sums = levels.table_lengths(df, forest.top, forest.branches, forest.size, counts, forest.n_rows)
        raw = [(-F.pow(F.lit(2.0), -F.col(f"s{i}") / n / F.lit(norm))).alias(f"s{i}") for i, n in enumerate(counts)]
        return sums.select(ROW_ID, *raw)
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(PackedForest(forest.nodes, forest.size, forest.psi))

    def run(batches):
        packed = shared.value
        for pdf in batches:
            lengths = [packed.lengths(x) for x in packed.blocks(pdf["features"])]
            if lengths:
                sums = np.cumsum(np.concatenate(lengths), axis=1)
                means = {f"s{i}": -np.exp2(-sums[:, n - 1] / n / norm) for i, n in enumerate(counts)}
                yield pd.DataFrame({ROW_ID: pdf[ROW_ID].to_numpy(), **means})

    fields = ", ".join(f"s{i} double" for i in range(len(counts)))
    return df.select(ROW_ID, "features").mapInPandas(run, f"{ROW_ID} bigint, {fields}")


def _separation(scored: DataFrame, column: str, percentile: float) -> dict:
    """Mean score above the percentile less the mean below it, spread, and share below."""
    cut = exact_percentiles(scored, column, [percentile / 100.0]).first()["percentile"]
    low = F.col(column) < cut
    row = scored.agg(
        (F.avg(F.when(~low, F.col(column))) - F.avg(F.when(low, F.col(column)))).alias("d"),
        F.stddev_pop(column).alias("sd"),
        F.avg(low.cast("int")).alias("ratio"),
    ).first()
    return {"separation_score": row["d"] or 0.0, "score_std": row["sd"], "anomaly_ratio": row["ratio"]}
