"""Training in synchronous rounds: the same weights on any cluster; kernels by random maps."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_models import matrix

from logloom.models import ocsvm
from logloom.models.autoencoder import Adam, Autoencoder, gradient, initial_weights, layer_sizes
from logloom.models.ocsvm import FeatureMap, OneClassSVM, gamma_value
from logloom.models.parallel import Blocks, vector_sum
from logloom.models.scaling import VectorScaler
from logloom.operators.tfidf import sparse_rows

AE = {"epochs": 3, "hidden_layers": [8], "encoding_dim": 3}


def numbers(df):
    ae = Autoencoder.fit(df, **AE)
    svm = OneClassSVM.fit(df, iterations=5, n_features=32)
    return [*ae.weights.tolist(), ae.threshold, *svm.w.tolist(), svm.rho]


def test_partitions_and_batches_change_nothing(spark):
    df = matrix(spark, n=1500)
    want = numbers(df.repartition(2))
    assert numbers(df.repartition(7, "row_id")) == want
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
        assert numbers(df) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_cores_change_nothing(spark):
    here = numbers(matrix(spark, n=700))
    root = Path(__file__).resolve().parents[1]
    code = (
        f"import sys; sys.path[:0] = [{str(root)!r}, {str(root / 'tests')!r}]\n"
        "import json\nfrom logloom.session import get_session\n"
        "from test_models import matrix\nfrom test_parallel import numbers\n"
        "spark = get_session('t', 'local[2]', spark__ui__enabled='false', spark__sql__shuffle__partitions=3)\n"
        "print('numbers', json.dumps(numbers(matrix(spark, n=700))))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    line = [x for x in out.stdout.splitlines() if x.startswith("numbers ")]
    assert line, out.stderr[-2000:]
    assert json.loads(line[0][8:]) == here


def test_sparse_blocks_equal_dense_blocks(spark):
    df = matrix(spark, n=600, d=5)
    cells = df.select("row_id", F.posexplode("features").alias("term_index", "weight"))
    sparse = sparse_rows(cells).select("row_id", F.struct("indices", "values").alias("features"))
    dense, thin = (Blocks.pack(d, 5, groups=3) for d in (df, sparse))
    assert dense.counts == thin.counts and dense.n_rows == 605
    x = np.array([r.features for r in df.collect()])
    for blocks in (dense, thin):
        assert blocks.sum(lambda b: b.sum(axis=0), 5, None, 5) == pytest.approx(x.mean(axis=0))
        groups = [blocks.sum(lambda b: b.sum(axis=0), 5, None, 5, g) * blocks.counts[g] for g in range(3)]
        assert sum(groups) / 605 == pytest.approx(x.mean(axis=0))


def test_many_vectors_are_added_as_a_tree(spark):
    vectors = spark.range(0, 100, 1, 100).select(
        F.concat(F.unhex(F.lpad(F.hex("id"), 2, "0")), F.unhex(F.lit("00" * 7))).alias("v")
    )
    assert vector_sum(vectors, 100, 1).tolist() == [sum(range(100))]


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    sizes = layer_sizes(4, [3], 2)
    flat, x = initial_weights(sizes, 1) + rng.normal(size=48) / 10, rng.normal(size=(6, 4))

    def loss(w):
        return gradient(x, w, sizes)[-1] * 4  # the sum of squared errors

    got = gradient(x, flat, sizes)[:-1]
    for i in range(0, len(flat), 5):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, rel=1e-4, abs=1e-6)
    adam = Adam(len(flat), 0.01)
    before = loss(flat)
    for _ in range(50):
        flat = adam.step(flat, gradient(x, flat, sizes)[:-1] / len(x))
    assert loss(flat) < 0.8 * before


@pytest.mark.parametrize("degree, coef0", [(1, 0.0), (2, 1.0), (3, 0.0), (3, 0.5)])
def test_tensor_sketch_gives_the_polynomial_kernel(degree, coef0):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20, 6))
    exact = (x @ x.T / 6 + coef0) ** degree
    found = np.mean([(lambda z: z @ z.T)(FeatureMap("poly", 6, 1 / 6, 512, s, degree, coef0)(x)) for s in range(60)], axis=0)
    assert np.abs(found - exact).max() < 0.15 * np.abs(exact).max()


def test_polynomial_detector_and_gamma(spark):
    df = matrix(spark, n=300).withColumn("features", F.concat("features", F.array(F.lit(7.0), F.lit(0.0))))
    scaler = VectorScaler.fit(df, 10)
    assert scaler.varying == 8
    assert gamma_value("auto", scaler) == 0.1 and gamma_value("scale", scaler) == 0.125 and gamma_value(2, scaler) == 2.0
    model = OneClassSVM.fit(df, kernel="poly", nu=0.1)
    labels = [r.anomaly_label for r in model.score(df).collect()]
    assert abs(labels.count(-1) - 30) <= 2
    kept = OneClassSVM.from_tables({}, json.loads(json.dumps(model.meta())))
    want = {r.row_id: r.score for r in model.score(df).collect()}
    assert {r.row_id: r.score for r in kept.score(df).collect()} == want
    assert {r.row_id: r.score for r in model.training_scores().collect()} == pytest.approx(want)


def test_twelve_settings(spark):
    df = matrix(spark, n=200)
    model = ocsvm.tune(df, iterations=6, n_features=64)
    table = {(r.kernel, r.nu, r.gamma): r.score_std for r in ocsvm.tuning_table(spark, model).collect()}
    assert len(table) == 12 and all(v > 0 for v in table.values())
    best = max(table, key=table.get)
    assert (model.params["kernel"], model.params["nu"], model.params["gamma"]) == best
    alone = OneClassSVM.fit(df, iterations=6, n_features=64, kernel=best[0], nu=best[1], gamma=best[2])
    assert alone.w == pytest.approx(model.w) and alone.rho == pytest.approx(model.rho)


@pytest.mark.parametrize("parts", [1, 4, 5, 12, 16, 40])
def test_few_vectors_reach_the_driver(spark, monkeypatch, parts):
    vectors = spark.range(0, 40, 1, parts).select(F.col("id")).mapInPandas(
        lambda pdfs: (pd.DataFrame({"v": [np.array([p["id"].sum()], np.int64).tobytes()]}) for p in pdfs), "v binary"
    )
    collect, sent = type(vectors).collect, []

    def counted(df):
        rows = collect(df)
        sent.append(len(rows))
        return rows

    monkeypatch.setattr(type(vectors), "collect", counted)
    assert vector_sum(vectors, parts, 1).tolist() == [sum(range(40))]
    assert len(sent) == 1 and sent[0] <= 4
