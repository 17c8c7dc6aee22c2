import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom.models import iforest, ocsvm
from logloom.models.matrix import block, sparse_blocks
from logloom.models.registry import Detector, batch_summary, model_versions, train
from logloom.models.scaling import VectorScaler, minmax_probability
from logloom.operators.tfidf import sparse_rows


def matrix(spark, planted=5, n=95, d=8, seed=42):
    """Normal rows and a few far away."""
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(size=(n, d)), rng.normal(size=(planted, d)) * 10 + 5])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id bigint, features array<double>")


SETTINGS = {
    "isolation_forest": {"n_estimators": 60},
    "one_class_svm": {"iterations": 12},
    "autoencoder": {"epochs": 6, "learning_rate": 0.01, "hidden_layers": [16, 8], "encoding_dim": 4},
}


@pytest.mark.parametrize("name", sorted(SETTINGS))
def test_contract(spark, name, tmp_path):
    df = matrix(spark)
    detector = train(df, name, **SETTINGS[name])
    rows = detector.score(df).collect()
    assert len(rows) == 100
    assert {r.anomaly_label for r in rows} <= {-1, 1}
    assert all(0 <= r.anomaly_score <= 1 and 0 <= r.confidence <= 1 for r in rows)
    assert max(r.anomaly_score for r in rows) == 1 and min(r.anomaly_score for r in rows) == 0
    assert any(r.row_id >= 95 and r.anomaly_label == -1 for r in rows)
    by_rank = sorted(rows, key=lambda r: r.score)
    assert {r.row_id for r in by_rank[:3]} <= set(range(95, 100))

    detector.save(spark, str(tmp_path), "v1")
    loaded = Detector.load(spark, str(tmp_path))
    assert loaded.metadata()["params"] == detector.model.params and loaded.version == "v1"
    want = {r.row_id: (r.score, r.anomaly_label) for r in rows}
    got = {r.row_id: (r.score, r.anomaly_label) for r in loaded.score(df, bounds="fitted").collect()}
    assert got.keys() == want.keys()
    for k, (score, label) in want.items():
        assert got[k] == (pytest.approx(score), label)


def test_forest_does_not_depend_on_partitions(spark):
    df = matrix(spark, n=400)
    kw = {"n_estimators": 20, "max_samples": 64, "calibrate": False}
    a = iforest.IsolationForest.fit(df.repartition(2), **kw).nodes
    b = iforest.IsolationForest.fit(df.repartition(7, "row_id"), **kw).nodes
    order = ["tree", "node"]
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (a, b))
    assert a.equals(b)
    roots = a[a["node"] == 0]
    assert len(roots) == 20 and (roots["size"] == 64).all()


def test_forest_samples_from_a_pool(spark):
    """With more rows than the pool holds, every tree is still full."""
    df = spark.range(20_000).select(
        F.col("id").alias("row_id"), F.array(F.rand(1), F.rand(2)).alias("features")
    )
    model = iforest.IsolationForest.fit(df, n_estimators=30, max_samples=64, calibrate=False)
    roots = model.nodes[model.nodes["node"] == 0]
    assert len(roots) == 30 and (roots["size"] == 64).all()


def test_forest_scores_against_plain_descent(spark):
    df = matrix(spark, n=120)
    model = iforest.IsolationForest.fit(df, n_estimators=15, max_samples=50, calibrate=False)
    x = {r.row_id: r.features for r in df.collect()}
    trees = [t.set_index("node") for _, t in model.nodes.groupby("tree")]
    norm = iforest.average_path(np.array([50]))[0]

    def path(tree, v):
        node = tree.loc[0]
        while node["feature"] >= 0:
            left = v[int(node["feature"])] <= node["threshold"]
            node = tree.loc[int(node["left"] if left else node["right"])]
        return node["depth"] + iforest.average_path(np.array([node["size"]]))[0]

    for r in model.raw_scores(df).where("row_id % 13 = 0").collect():
        want = -(2 ** (-np.mean([path(t, x[r.row_id]) for t in trees]) / norm))
        assert r.raw == pytest.approx(want)


def test_contamination_sets_the_share(spark):
    df = matrix(spark, n=380, planted=20)
    model = train(df, n_estimators=50, contamination=0.1).model
    labels = [r.anomaly_label for r in model.score(df).collect()]
    assert labels.count(-1) == 40
    assert model.threshold is not None and model.n_rows == 400


def test_sparse_rows_score_like_dense_rows(spark):
    df = matrix(spark, d=5)
    cells = df.select("row_id", F.posexplode("features").alias("term_index", "weight"))
    sparse = sparse_rows(cells).select("row_id", F.struct("indices", "values").alias("features"))
    for name in SETTINGS:
        kw = dict(SETTINGS[name], size=5)
        dense_scores = {r.row_id: r.score for r in train(df, name, **kw).model.score(df).collect()}
        model = train(sparse, name, **kw).model
        for r in model.score(sparse).collect():
            assert r.score == pytest.approx(dense_scores[r.row_id])


def test_tuning(spark):
    df = matrix(spark, n=150)
    model = iforest.tune(df, n_estimators=(10, 20), max_samples=(0.5, 1.0))
    assert len(model.tuning) == 4
    best = max(model.tuning, key=lambda r: r["separation_score"])
    assert model.params["n_estimators"] == best["n_estimators"]
    svm = ocsvm.tune(df, nu=(0.05, 0.2), iterations=4)
    assert len(svm.tuning) == 8 and svm.params["nu"] in (0.05, 0.2)
    tuned = train(df, "isolation_forest", tune=True, n_estimators=(10,), max_samples=(0.5,))
    assert tuned.model.params["contamination"] == 0.05


def test_autoencoder_learns(spark):
    history = train(matrix(spark, n=300), "autoencoder", **{**SETTINGS["autoencoder"], "epochs": 10}).model.history
    assert len(history) == 10 and history[-1] < history[0]


def test_unknown_model_and_kernel(spark):
    with pytest.raises(ValueError, match="unknown model"):
        train(matrix(spark), "nothing")
    with pytest.raises(ValueError, match="sigmoid"):
        train(matrix(spark), "one_class_svm", kernel="sigmoid")


def test_versions(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Detector.load(spark, str(tmp_path / "none"))
    d = train(matrix(spark), n_estimators=5)
    for v in ("v1", "v3", "v2"):
        d.save(spark, str(tmp_path), v)
    assert Detector.load(spark, str(tmp_path)).version == "v3"
    assert Detector.load(spark, str(tmp_path), "v2").version == "v2"
    assert model_versions(spark, str(tmp_path)).count() == 3


def test_scaler(spark):
    df = matrix(spark).withColumn("features", F.transform("features", lambda v: v + 1e6))
    scaler = VectorScaler.fit(df, 8)
    x = np.array([r.features for r in df.collect()])
    assert scaler.mean == pytest.approx(x.mean(axis=0))
    assert scaler.sd == pytest.approx(x.std(axis=0), rel=1e-6)
    folded = VectorScaler.fit(df, 8, max_dims=3)
    assert folded.dims == 3 and len(folded.mean) == 3


def test_probability_bounds(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,), (None,)], "score double")
    got = [r.anomaly_score for r in minmax_probability(df, bounds=(0.0, 2.0)).collect()]
    assert got == [1.0, 0.5, 0.0, None]
    single = minmax_probability(df.limit(1)).first().anomaly_score
    assert single == 0.5


def test_summary(spark):
    df = spark.createDataFrame([(True,), (False,)], "is_anomaly_detected boolean")
    assert tuple(batch_summary(df).first()) == (2, 1, 0.5)
    assert tuple(batch_summary(df.where("false")).first()) == (0, 0, 0.0)


def test_workers_get_the_package(tmp_path):
    """A driver started elsewhere: tasks still find the package."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from pyspark.sql import functions as F\n"
        "from logloom.session import get_session\n"
        "from logloom.models.registry import train\n"
        "spark = get_session('t', 'local[2]', spark__ui__enabled='false')\n"
        "df = spark.range(50).select(F.col('id').alias('row_id'), F.array(F.rand(1)).alias('features'))\n"
        "print('rows', train(df, n_estimators=3).score(df).count())\n"
    )
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert "rows 50" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("rows", [1, 3, 7, 100])
def test_sparse_blocks_are_blocks_of_slices(rows):
    """Also where rows hold nothing, or nothing that the forest looks at."""
    cells = [([0, 2], [1.0, 2.0]), ([], []), ([1], [5.0]), ([2, 2], [1.0, 4.0]), ([3], [-0.5]), ([0, 1, 2, 3], [1.0] * 4), ([], [])]
    col = pd.DataFrame({"indices": [np.array(i, dtype=int) for i, _ in cells], "values": [np.array(v) for _, v in cells]})
    positions = np.array([1, -1, 0, 2])
    got = list(sparse_blocks(col, 3, positions, rows))
    want = [block(col.iloc[i : i + rows], 4, positions, 3) for i in range(0, len(col), rows)]
    assert len(got) == len(want) and all((g == w).all() and g.shape == w.shape for g, w in zip(got, want))
