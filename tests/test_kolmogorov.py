"""The exact p-value against all orders of small samples and against its closed form."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.functions.kolmogorov import _series, exact_p_value
from logloom.operators import evaluate as ev


def statistic(chosen, total, n):
    f = g = worst = 0
    m = total - n
    for i in range(total):
        f, g = f + (i in chosen), g + (i not in chosen)
        worst = max(worst, abs(f * m - g * n))
    return worst


@pytest.mark.parametrize("n, m", [(1, 1), (2, 3), (4, 4), (5, 3), (6, 7), (1, 8)])
def test_all_orders(n, m):
    every = [statistic(set(c), n + m, n) for c in combinations(range(n + m), n)]
    for h in sorted({0, *every}):
        want = sum(d >= h for d in every) / len(every)
        assert exact_p_value(h / (n * m), n, m) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("n, h", [(50, 9), (400, 31), (1000, 1000), (3000, 100)])
def test_closed_form_of_equal_sizes(n, h):
    lg = math.lgamma
    terms = [(-1) ** (k + 1) * math.exp(2 * lg(n + 1) - lg(n - k * h + 1) - lg(n + k * h + 1)) for k in range(1, n // h + 1)]
    assert exact_p_value(h / n, n, n) == pytest.approx(2 * sum(terms), rel=1e-7)


def test_large_samples_approach_the_limit():
    assert exact_p_value(0.03, 4000, 5000) == pytest.approx(_series(0.03, 4000, 5000), rel=0.1)
    assert exact_p_value(0.5, 2000, 3000) < 1e-200


def test_drift_uses_it(spark):
    rng = np.random.default_rng(1)
    a = spark.createDataFrame([(float(x),) for x in rng.normal(size=60)], "score double")
    b = spark.createDataFrame([(float(x),) for x in rng.normal(0.6, 1, size=45)], "score double")
    row = ev.ks_drift(a, b).first()
    assert row.p_value == pytest.approx(exact_p_value(row.statistic, 60, 45))
    assert row.drift_detected == (row.p_value < 0.05)
    none = ev.ks_drift(a, b.where(F.lit(False))).first()
    assert none.current_n == 0 and none.p_value is None and none.drift_detected is None
