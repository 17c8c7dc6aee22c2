"""Score and feature scaling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.models.matrix import chunks, feature_block, hashed_positions
from logloom.session import ship_package


def minmax_probability(
    df: DataFrame,
    score: str = "score",
    out: str = "anomaly_score",
    bounds: tuple[float, float] | None = None,
    inverted: bool = True,
) -> DataFrame:
    """Scores to 0..1, 1 being most anomalous; equal scores give 0.5.

    ``bounds`` are a fitted minimum and maximum (values outside are clipped);
    without them the batch's own range is used.
    """
    value = F.col(score)
    if bounds is None:
        ends = df.agg(F.struct(F.min(score).alias("lo"), F.max(score).alias("hi")).alias("e"))
        df = df.withColumn("_ends", ends.scalar())
        low, high = F.col("_ends.lo"), F.col("_ends.hi")
    else:
        low, high = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
        value = F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))
    part = (value - low) / F.nullif(high - low, F.lit(0.0))
    scaled = F.coalesce(1.0 - part if inverted else part, F.when(F.col(score).isNotNull(), 0.5))
    return df.withColumn(out, scaled).drop("_ends")


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Mean 0, population sd 1; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        ).alias("s")
    )
    wide = df.withColumn("_s", stats.scalar())
    return wide.withColumns(
        {
            f"{c}{suffix}": (F.col(c) - F.col(f"_s.{c}_m"))
            / F.when(F.col(f"_s.{c}_s") == 0, F.lit(1.0)).otherwise(F.col(f"_s.{c}_s"))
            for c in columns
        }
    ).drop("_s")


class VectorScaler:
    """Standardises features, folded to at most ``max_dims`` columns if that is given.

    Sums are exact (parallel.py), so the figures don't depend on partitions; what reaches the driver is the
    width of the matrix.
    """

    def __init__(self, size: int, dims: int, mean: np.ndarray, sd: np.ndarray, varying: int | None = None) -> None:
        self.size, self.dims, self.mean, self.sd = size, dims, mean, sd
        self.varying = dims if varying is None else varying

    @classmethod
    def fit(cls, df: DataFrame, size: int, max_dims: int | None = None) -> "VectorScaler":
        import pandas as pd

        from logloom.models.parallel import exact_sums

        ship_package(df.sparkSession)
        dims = min(size, max_dims or size)
        positions = hashed_positions(size, dims)

        def block(pdf) -> np.ndarray:
            return feature_block(pdf["features"], size, positions=positions, width=dims)

        def ends(batches):
            n, low, high = 0, np.full(dims, np.inf), np.full(dims, -np.inf)
            for pdf in batches:
                for part in chunks(pdf):
                    x = block(part)
                    n, low, high = n + len(x), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
            yield pd.DataFrame({"n": [n], "low": [low.tolist()], "high": [high.tolist()]})

        def widest(batches):
            n, low, high = 0, np.full(dims, np.inf), np.full(dims, -np.inf)
            for pdf in batches:
                n += int(pdf["n"].sum())
                low, high = np.minimum.reduce([low, *pdf["low"]]), np.maximum.reduce([high, *pdf["high"]])
            yield pd.DataFrame({"n": [n], "low": [low.tolist()], "high": [high.tolist()]})

        kind = "n bigint, low array<double>, high array<double>"
        found = df.select("features").mapInPandas(ends, kind).coalesce(32).mapInPandas(widest, kind).collect()
        n = sum(r["n"] for r in found)
        if n == 0:
            return cls(size, dims, np.zeros(dims), np.ones(dims), 0)
        low, high = np.min([r["low"] for r in found], axis=0), np.max([r["high"] for r in found], axis=0)
        # Sums about the middle of the range, then squares about the mean: plain sums
        # lose digits when values are large against their spread.
        middle = low + (high - low) / 2
        mean = middle + exact_sums(df, lambda pdf: block(pdf) - middle, high - low, n) / n
        widest_square = np.maximum(high - mean, mean - low) ** 2
        sd = np.sqrt(exact_sums(df, lambda pdf: (block(pdf) - mean) ** 2, widest_square, n) / n)
        varying = int((sd > 0).sum())
        sd[sd == 0] = 1.0
        return cls(size, dims, mean, sd, varying)

    @property
    def positions(self) -> np.ndarray:
        return hashed_positions(self.size, self.dims)

    def block(self, col) -> np.ndarray:
        return self.scaled(feature_block(col, self.size, positions=self.positions, width=self.dims))

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.sd

    def meta(self) -> dict:
        return {
            "size": self.size,
            "dims": self.dims,
            "mean": self.mean.tolist(),
            "sd": self.sd.tolist(),
            "varying": self.varying,
        }

    @classmethod
    def from_meta(cls, meta: dict) -> "VectorScaler":
        return cls(meta["size"], meta["dims"], np.array(meta["mean"]), np.array(meta["sd"]), meta.get("varying"))
