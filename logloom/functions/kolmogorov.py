"""The exact distribution of the two-sample Kolmogorov-Smirnov statistic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the largest sample for which the exact distribution is used.
EXACT_ROWS = 10_000


def exact_p_value(d: float, n: int, m: int) -> float:
    """P(D >= d) for samples of n and m rows without ties.

    Merging two samples is a walk over a lattice from (0, 0) to (n, m), all orders being equally likely.
    The walk is followed diagonal by diagonal; what steps to a point where the two
    distribution functions are at least ``d`` apart leaves it, and is added up.  No
    difference is ever taken, so small probabilities keep their digits.
    """
    most = round(d * n * m)
    if most <= 0:
        return 1.0
    total, outside = n + m, 0.0
    weight = np.zeros(n + 1)
    weight[0] = 1.0
    low = high = 0
    for s in range(total):
        # From i steps in the first sample and s - i in the second.
        i = np.arange(low, high + 1)
        here = weight[low : high + 1]
        first, second = here * (n - i) / (total - s), here * (m - (s - i)) / (total - s)
        step = np.zeros(high - low + 2)
        step[:-1] += second
        step[1:] += first
        low, high = max(0, low), min(n, high + 1)
        to = np.arange(low, high + 1)
        step = step[: len(to)]
        apart = np.abs(to * m - (s + 1 - to) * n) >= most
        outside += float(step[apart].sum())
        step[apart] = 0.0
        inside = np.flatnonzero(step)
        if not len(inside):
            break
        weight[low : high + 1] = step
        low, high = low + int(inside[0]), low + int(inside[-1])
    return min(1.0, outside)


def _series(d: float, n: int, m: int, terms: int = 100) -> float:
    """The limit for large samples."""
    lam = math.sqrt(n * m / (n + m)) * d
    if lam < 0.1:
        return 1.0
    k = np.arange(1, terms + 1)
    return float(np.clip(2 * ((-1.0) ** (k - 1) * np.exp(-2.0 * (k * lam) ** 2)).sum(), 0.0, 1.0))


def ks_p_value(d: Column, n: Column, m: Column, exact_rows: int = EXACT_ROWS) -> Column:
    """Two-sided p-value: exact up to ``exact_rows`` rows in the larger sample, the limit beyond.

    It is taken for one row of totals, never for rows of data.
    """

    @F.pandas_udf(T.DoubleType())
    def p_value(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        def one(d, n, m):
            if pd.isna(d) or pd.isna(n) or pd.isna(m) or n == 0 or m == 0:
                return None
            of = exact_p_value if max(n, m) <= exact_rows else _series
            return of(float(d), int(n), int(m))

        return pd.Series([one(*x) for x in zip(d, n, m)], dtype=float)

    return p_value(d, n.cast("bigint"), m.cast("bigint"))
