"""Exact top-k search and hard-negative mining against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import hardneg, tiles, topk
from logloom.llm.queries_vectors import op12_exact_topk, op13_hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, block string"


def whole(rows, scale, label):
    out = []
    for r in rows:
        v = r[1]
        if r[0] is None or v is None or (label and r[2] is None) or any(x is None or not math.isfinite(x) for x in v):
            continue
        out.append((r[0], [math.floor(scale * x) for x in v], r[2]))
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_topk(rows, every, k, scale):
    use = whole(rows, scale, False)
    out = []
    for q, v, _ in use:
        if q % every == 0:
            found = sorted((-dot(v, w), c) for c, w, _ in use if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(found)]
    return sorted(out)


def brute_negatives(rows, every):
    use = whole(rows, 256, True)
    out = []
    for q, v, label in use:
        if q % every:
            continue
        scored = sorted((-dot(v, w), c, other) for c, w, other in use if c != q)
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(q, pid, i + 1, c, -p, -s) for i, (s, c, _) in enumerate(window)]
    return sorted(out)


def odd_rows(n=400, width=6, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(width)], rng.randrange(4), "clash", "clash") for i in range(n)]
    rows += [(n + i, [0.25] * width, 1, None, None) for i in range(150)]  # one vector many times: ties
    rows += [(i * 20 + 1000, list(rows[5][1]), i % 4, None, None) for i in range(20)]
    rows += [
        (5000, None, 1, None, None),
        (5020, [], 1, None, None),
        (5040, [0.5, None], 1, None, None),
        (5060, [float("nan")] * width, 1, None, None),
        (5080, [float("inf")] * width, 1, None, None),
        (5100, [0.5] * width, None, None, None),
        (5120, [1.0, -2.0], 2, None, None),
        (None, [0.5] * width, 1, None, None),
        (-20, [0.0] * width, 3, None, None),
    ]
    rows += [rows[3], rows[3], rows[7]]
    return rows


@pytest.fixture(scope="module")
def odd_vectors(spark):
    frame = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    return frame, [tuple(r) for r in frame.collect()]


def test_topk_of_odd_rows(odd_vectors):
    frame, rows = odd_vectors
    got = sorted(tuple(r) for r in topk.search(frame, F.col("vec_id") % 20 == 0, k=7).collect())
    assert got == brute_topk(rows, 20, 7, 64)


def test_negatives_of_odd_rows(odd_vectors):
    frame, rows = odd_vectors
    got = sorted(tuple(r) for r in hardneg.mine(frame, F.col("vec_id") % 10 == 0).collect())
    assert got and got == brute_negatives(rows, 10)


def test_many_blocks_and_cells(odd_vectors, monkeypatch):
    """Small blocks, bands and fan-in give the same lists through several merges."""
    frame, rows = odd_vectors
    monkeypatch.setattr(tiles, "FAN_IN", 2)
    monkeypatch.setattr(tiles.Grid, "of", classmethod(lambda cls, *sizes: cls(3, 5)))
    got = sorted(tuple(r) for r in topk.search(frame, F.col("vec_id") % 5 == 0, k=3).collect())
    assert got == brute_topk(rows, 5, 3, 64)
    mined = sorted(tuple(r) for r in hardneg.mine(frame, F.col("vec_id") % 10 == 0).collect())
    assert mined == brute_negatives(rows, 10)


def test_few_candidates_and_large_numbers(spark):
    rows = [(i, [1e6 * (i - 1), 3e7, float(i)], 0, None, None) for i in range(4)] + [(40, [3e14, 2e14, 1e14], 1, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    stored = [tuple(r) for r in frame.collect()]
    got = sorted(tuple(r) for r in topk.search(frame.where("vec_id < 40"), F.lit(True)).collect())
    assert got == brute_topk(stored[:4], 1, 20, 64)
    # Beyond 64 bits scores stay at the limit, ties by id.
    huge = topk.search(frame, F.col("vec_id") == 40).collect()
    assert [r.vec_id for r in huge if r.score == 2**63 - 1] == sorted(r.vec_id for r in huge if r.score == 2**63 - 1)


def test_slots_share_windows(spark):
    """Equal positives share a slot; a positive without a window has no row."""
    rows = [(0, [1.0, 0.0], 1)] + [(i, [1.0, 0.0], 1) for i in (1, 2)] + [(3, [0.6, 0.0], 1), (4, [-0.5, 0.0], 1)]
    rows += [(10 + i, [x, 0.0], 2) for i, x in enumerate((0.99, 0.95, 0.9, 0.9, 0.6, 0.5, 0.3, 0.2, -0.4, -0.48))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in hardneg.mine(frame, F.col("vec_id") == 0).collect())
    assert got == [r for r in brute_negatives(rows, 1) if r[0] == 0]
    assert {r[1] for r in got} == {1, 2, 3}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert topk.search(none, F.col("vec_id") % 20 == 0).count() == 0
    assert hardneg.mine(none, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0], 1, None, None)], SCHEMA)
    assert topk.search(one, F.col("vec_id") % 20 == 0).count() == 0
    assert topk.search(one, F.lit(False)).count() == 0


def test_given_vectors(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in op12_exact_topk(spark, sf).collect()) == brute_topk(rows, 20, 20, 64)
    moved = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in rows]
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, sf).collect()) == brute_negatives(moved, 50)


def test_products_keep_whole_numbers():
    rng = np.random.default_rng(1)
    for most in (100, 10**5, 10**8):
        a, b = rng.integers(-most, most, (5, 9)), rng.integers(-most, most, (4, 9))
        got, _ = tiles.products(a, b)
        assert (got.astype(np.int64) == a @ b.T).all()
