"""One-class SVM on random feature maps of a kernel.

The kernel is replaced by a fixed random map, in which the problem is linear and its gradient a
sum over rows:
    minimise  |w|^2/2 - rho + mean(max(0, rho - w.z(x))) / nu.
The RBF kernel takes random Fourier features (Rahimi and Recht, 2007).  The polynomial kernel
(gamma x.y + coef0)^degree takes a tensor sketch (Pham and Pagh, 2013): count sketches of x, one for each
factor, whose circular convolution is the product of their Fourier transforms.
Scores approximate the exact kernel solution; they are not the same numbers.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.models.iforest import feature_size
from logloom.models.matrix import chunks
from logloom.models.parallel import Blocks
from logloom.models.scaling import VectorScaler
from logloom.operators.ordered import percentile_values
from logloom.schema import ROW_ID
from logloom.session import materialize, ship_package

# Defaults of the detector.
DEFAULTS = {"kernel": "rbf", "gamma": "scale", "nu": 0.05, "degree": 3, "coef0": 0.0}
KERNELS = ("rbf", "poly")


class FeatureMap:
    """A random map of standardised rows; drawn from the seed, so it is stored as its settings."""

    def __init__(self, kernel: str, dims: int, gamma: float, n_features: int, seed: int, degree: int = 3, coef0: float = 0.0) -> None:
        if kernel not in KERNELS:
            raise ValueError(f"unknown kernel {kernel!r}; available: {KERNELS}")
        self.settings = {
            "kernel": kernel, "dims": dims, "gamma": gamma, "n_features": n_features, "seed": seed, "degree": degree, "coef0": coef0,
        }
        rng = np.random.default_rng(seed)
        if kernel == "rbf":
            self.omega = rng.normal(0.0, np.sqrt(2.0 * gamma), (dims, n_features))
            self.phase = rng.uniform(0.0, 2.0 * np.pi, n_features)
        else:
            # The constant joins as one more column: (gamma x.y + coef0) is an inner product of longer rows.
            rows = np.arange(dims + 1)
            self.sketches = []
            for _ in range(degree):
                sketch = np.zeros((dims + 1, n_features))
                sketch[rows, rng.integers(n_features, size=dims + 1)] = rng.choice([-1.0, 1.0], dims + 1)
                self.sketches.append(sketch)

    def __reduce__(self):
        s = self.settings
        return FeatureMap, (s["kernel"], s["dims"], s["gamma"], s["n_features"], s["seed"], s["degree"], s["coef0"])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = self.settings
        if s["kernel"] == "rbf":
            return np.sqrt(2.0 / s["n_features"]) * np.cos(x @ self.omega + self.phase)
        longer = np.concatenate([np.sqrt(s["gamma"]) * x, np.full((len(x), 1), np.sqrt(s["coef0"]))], axis=1)
        product = np.fft.rfft(longer @ self.sketches[0], axis=1)
        for sketch in self.sketches[1:]:
            product = product * np.fft.rfft(longer @ sketch, axis=1)
        return np.fft.irfft(product, n=s["n_features"], axis=1)


def gamma_value(gamma, scaler: VectorScaler) -> float:
    """"auto" is 1 / columns, "scale" 1 / (columns * variance of all cells): constant columns make the difference."""
    if gamma == "auto":
        return 1.0 / scaler.dims
    if gamma == "scale":
        return 1.0 / max(1, scaler.varying)
    return float(gamma)


@dataclass
class OneClassSVM:
    scaler: VectorScaler
    feature_map: FeatureMap
    w: np.ndarray
    rho: float
    params: dict
    score_min: float | None = None
    score_max: float | None = None
    tuning: list[dict] | None = None
    n_rows: int = 0
    training_margins: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        size: int | None = None,
        n_features: int = 256,
        max_dims: int | None = None,
        iterations: int = 40,
        random_state: int = 42,
        **params,
    ) -> "OneClassSVM":
        model = cls._fit_all(df, [{**DEFAULTS, **params}], size, n_features, max_dims, iterations, random_state)[0]
        model._calibrate(materialize(margins(df, [model]), "margins"), "m0")
        return model

    @classmethod
    def _fit_all(cls, df, settings: list[dict], size, n_features, max_dims, iterations, seed) -> list["OneClassSVM"]:
        """Several settings in the same rounds: a block is mapped once for all that share a map."""
        size = size or feature_size(df)
        scaler = VectorScaler.fit(df, size, max_dims)
        blocks = Blocks.pack(df, size)
        kinds = [(s["kernel"], gamma_value(s["gamma"], scaler), s["degree"], s["coef0"]) for s in settings]
        names = list(dict.fromkeys(kinds))
        maps = [FeatureMap(k, scaler.dims, g, n_features, seed, d, c) for k, g, d, c in names]
        at = [names.index(k) for k in kinds]
        nus = np.array([float(s["nu"]) for s in settings])

        def means(x):
            x = scaler.scaled(x)
            return np.concatenate([m(x).sum(axis=0) for m in maps])

        first = blocks.sum(means, n_features * len(maps), scaler.positions, scaler.dims)
        w = np.stack([first[n_features * i : n_features * (i + 1)] for i in at])
        rho = 0.9 * (w * w).sum(axis=1)
        for step in range(1, iterations + 1):

            def outside(x, w=w, rho=rho):
                """For every setting, the sum of the mapped rows below rho, and their number."""
                x = scaler.scaled(x)
                mapped = [m(x) for m in maps]
                parts = []
                for i, k in enumerate(at):
                    out = mapped[k] @ w[i] < rho[i]
                    parts.append(np.append(mapped[k][out].sum(axis=0), out.sum()))
                return np.concatenate(parts)

            total = blocks.sum(outside, (n_features + 1) * len(settings), scaler.positions, scaler.dims)
            total = total.reshape(len(settings), n_features + 1)
            rate = 1.0 / (step + 1.0)
            w = (1.0 - rate) * w + rate * total[:, :-1] / nus[:, None]
            norm = np.maximum((w * w).sum(axis=1), 1e-12)
            rho = rho - 0.5 * rate * (total[:, -1] / nus - 1.0) * norm
        return [
            cls(scaler, maps[k], w[i], float(rho[i]), settings[i], n_rows=blocks.n_rows) for i, k in enumerate(at)
        ]

    def _calibrate(self, raw: DataFrame, column: str) -> None:
        """For a fixed w the best rho is the nu-quantile of w.z(x): set it exactly."""
        ends = raw.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        self.rho = percentile_values(raw, column, [float(self.params["nu"])])[0]
        self.score_min, self.score_max = ends["lo"] - self.rho, ends["hi"] - self.rho
        self.training_margins = raw.select(ROW_ID, F.col(column).alias("margin"))

    def training_scores(self) -> DataFrame:
        """``(row_id, score, anomaly_label)`` of the training rows, from the margins that set the offset."""
        score = (F.col("margin") - F.lit(self.rho)).alias("score")
        return labelled(self.training_margins.select(ROW_ID, score))

    def score(self, df: DataFrame) -> DataFrame:
        """Replaces ``features`` by ``score`` (low = anomalous) and ``anomaly_label``."""
        shared = df.sparkSession.sparkContext.broadcast((self.scaler, self.feature_map, self.w, self.rho))

        def run(col) -> pd.Series:
            scaler, mapped, w, rho = shared.value
            parts = [mapped(scaler.block(c)) @ w - rho for c in chunks(col)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        return apply_scores(df, run)

    def meta(self) -> dict:
        return {
            "scaler": self.scaler.meta(),
            "feature_map": self.feature_map.settings,
            "w": self.w.tolist(),
            "rho": self.rho,
            "params": self.params,
            "score_min": self.score_min,
            "score_max": self.score_max,
            "n_rows": self.n_rows,
        }

    @property
    def size(self) -> int:
        return self.scaler.size

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {}

    @classmethod
    def from_tables(cls, tables: dict, meta: dict) -> "OneClassSVM":
        meta = dict(meta)
        return cls(
            scaler=VectorScaler.from_meta(meta.pop("scaler")),
            feature_map=FeatureMap(**meta.pop("feature_map")),
            w=np.array(meta.pop("w")),
            **meta,
        )


def apply_scores(df: DataFrame, run) -> DataFrame:
    """Score with a Series-to-Series function; label is -1 below zero."""
    ship_package(df.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def plain(col: pd.Series) -> pd.Series:
        return run(col)

    @F.pandas_udf(T.DoubleType())
    def struct(col: pd.DataFrame) -> pd.Series:
        return run(col)

    udf = struct if dict(df.dtypes)["features"].startswith("struct") else plain
    return labelled(df.withColumn("score", udf("features")).drop("features"))


def labelled(scored: DataFrame) -> DataFrame:
    return scored.withColumn("anomaly_label", F.when(F.col("score") < 0, -1).otherwise(1))


def margins(df: DataFrame, models: list[OneClassSVM]) -> DataFrame:
    """``row_id`` and w.z(x) of every model as ``m<i>``, in one pass; models of one fit share the scaler."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(
        (models[0].scaler, [(json.dumps(m.feature_map.settings), m.feature_map, m.w) for m in models])
    )

    def run(batches):
        scaler, known = shared.value
        for pdf in batches:
            for part in chunks(pdf):
                x = scaler.block(part["features"])
                mapped = {}
                out = {ROW_ID: part[ROW_ID].to_numpy()}
                for i, (name, of, w) in enumerate(known):
                    if name not in mapped:
                        mapped[name] = of(x)
                    out[f"m{i}"] = mapped[name] @ w
                yield pd.DataFrame(out)

    fields = ", ".join(f"m{i} double" for i in range(len(models)))
    return df.select(ROW_ID, "features").mapInPandas(run, f"{ROW_ID} bigint, {fields}")


def tune(
    df: DataFrame,
    kernel: tuple = KERNELS,
    nu: tuple = (0.01, 0.05, 0.1),
    gamma: tuple = ("scale", "auto"),
    size: int | None = None,
    n_features: int = 256,
    max_dims: int | None = None,
    iterations: int = 40,
    random_state: int = 42,
    **params,
) -> OneClassSVM:
    """Keep the setting whose scores have the largest standard deviation.

    All settings are trained in the same rounds and scored in one pass; ``tuning`` has their figures.
    """
    settings = [{**DEFAULTS, **params, "kernel": k, "nu": n, "gamma": g} for k in kernel for n in nu for g in gamma]
    models = OneClassSVM._fit_all(df, settings, size, n_features, max_dims, iterations, random_state)
    raw = materialize(margins(df, models), "margins")
    spread = raw.agg(*[F.stddev_pop(f"m{i}").alias(f"m{i}") for i in range(len(models))]).first()
    results = [{"kernel": s["kernel"], "nu": s["nu"], "gamma": s["gamma"], "score_std": spread[f"m{i}"]} for i, s in enumerate(settings)]
    best = max(range(len(models)), key=lambda i: spread[f"m{i}"])
    models[best]._calibrate(raw, f"m{best}")
    models[best].tuning = results
    return models[best]


TUNING = "kernel string, nu double, gamma string, score_std double"


def tuning_table(spark: SparkSession, model: OneClassSVM) -> DataFrame:
    """The figures of every setting that ``tune`` tried."""
    rows = [(r["kernel"], float(r["nu"]), str(r["gamma"]), r["score_std"]) for r in model.tuning]
    return spark.createDataFrame(rows, TUNING)
