"""Dense autoencoder; a row that is rebuilt badly is anomalous.

Training is synchronous: an epoch visits the mini-batches that parallel.py made, each in one
Spark job that returns the mean gradient of all its rows, and the driver takes one Adam step
(Kingma and Ba, 2015) per mini-batch.  The rows of a mini-batch grow with the table, the number of steps doesn't.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.models.iforest import feature_size
from logloom.models.matrix import chunks
from logloom.models.ocsvm import apply_scores
from logloom.models.parallel import Blocks
from logloom.models.scaling import VectorScaler
from logloom.operators.ordered import percentile_values
from logloom.schema import ROW_ID
from logloom.session import materialize

# Defaults of the detector.
DEFAULTS = {
    "encoding_dim": 32,
    "hidden_layers": [128, 64],
    "epochs": 50,
    "learning_rate": 0.001,
    "threshold_percentile": 95.0,
}
# Mini-batches of an epoch; each holds this part of all rows.
BATCHES = 4


def layer_sizes(dims: int, hidden: list[int], encoding: int) -> list[int]:
    half = [dims, *hidden, encoding]
    return half + half[-2::-1]


def initial_weights(sizes: list[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:]):
        limit = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-limit, limit, a * b), np.zeros(b)]
    return np.concatenate(parts)


def unpack(flat: np.ndarray, sizes: list[int]):
    at, layers = 0, []
    for a, b in zip(sizes, sizes[1:]):
        w = flat[at : at + a * b].reshape(a, b)
        at += a * b
        layers.append((w, flat[at : at + b]))
        at += b
    return layers


def forward(x: np.ndarray, layers) -> list[np.ndarray]:
    outs = [x]
    for k, (w, b) in enumerate(layers):
        z = outs[-1] @ w + b
        outs.append(z if k == len(layers) - 1 else np.maximum(z, 0.0))
    return outs


def gradient(x: np.ndarray, flat: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Sums over rows: the gradient of the squared error over all weights, then the mean squared error per row."""
    layers = unpack(flat, sizes)
    outs = forward(x, layers)
    error = outs[-1] - x
    loss = float(np.mean(error**2, axis=1).sum())
    delta, parts = 2.0 * error, []
    for k in range(len(layers) - 1, -1, -1):
        parts += [delta.sum(axis=0), (outs[k].T @ delta).ravel()]
        if k:
            delta = (delta @ layers[k][0].T) * (outs[k] > 0)
    return np.concatenate([*parts[::-1], [loss]])


class Adam:
    """Steps with running means of the gradient and of its square."""

    def __init__(self, n: int, rate: float, decay: tuple = (0.9, 0.999)) -> None:
        self.m, self.v, self.t, self.rate, self.decay = np.zeros(n), np.zeros(n), 0, rate, decay

    def step(self, flat: np.ndarray, g: np.ndarray) -> np.ndarray:
        a, b = self.decay
        self.t += 1
        self.m, self.v = a * self.m + (1 - a) * g, b * self.v + (1 - b) * g * g
        m, v = self.m / (1 - a**self.t), self.v / (1 - b**self.t)
        return flat - self.rate * m / (np.sqrt(v) + 1e-8)


@dataclass
class Autoencoder:
    scaler: VectorScaler
    sizes: list[int]
    weights: np.ndarray
    params: dict
    threshold: float = 0.0
    history: list[float] = field(default_factory=list)
    score_min: float | None = None
    score_max: float | None = None
    n_rows: int = 0
    training_errors: DataFrame | None = field(default=None, repr=False)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        size: int | None = None,
        max_dims: int | None = None,
        random_state: int = 42,
        batches: int = BATCHES,
        **params,
    ) -> "Autoencoder":
        settings = {**DEFAULTS, **params}
        size = size or feature_size(df)
        scaler = VectorScaler.fit(df, size, max_dims)
        blocks = Blocks.pack(df, size, batches)
        sizes = layer_sizes(scaler.dims, list(settings["hidden_layers"]), settings["encoding_dim"])
        flat = initial_weights(sizes, random_state)
        adam = Adam(len(flat), float(settings["learning_rate"]))
        spark, history = df.sparkSession, []
        filled = [g for g in range(batches) if blocks.counts[g]]
        for _ in range(int(settings["epochs"])):
            loss = 0.0
            for group in filled:
                shared = spark.sparkContext.broadcast(flat)
                total = blocks.sum(
                    lambda x, shared=shared: gradient(scaler.scaled(x), shared.value, sizes),
                    len(flat) + 1, scaler.positions, scaler.dims, group,
                )
                shared.destroy()
                flat = adam.step(flat, total[:-1])
                loss += total[-1] * blocks.counts[group]
            history.append(loss / max(1, blocks.n_rows))
        model = cls(scaler, sizes, flat, settings, history=history, n_rows=blocks.n_rows)
        errors = materialize(model.errors(df).select(ROW_ID, "error"), "errors")
        q = settings["threshold_percentile"] / 100.0
        model.threshold = percentile_values(errors, "error", [q])[0]
        ends = errors.agg(F.min("error").alias("lo"), F.max("error").alias("hi")).first()
        model.score_min, model.score_max = -ends["hi"], -ends["lo"]
        model.training_errors = errors
        return model

    def _error_function(self, spark: SparkSession):
        shared = spark.sparkContext.broadcast((self.scaler, self.sizes, self.weights))

        def run(col) -> pd.Series:
            scaler, sizes, flat = shared.value
            layers, parts = unpack(flat, sizes), []
            for c in chunks(col):
                x = scaler.block(c)
                parts.append(np.mean((x - forward(x, layers)[-1]) ** 2, axis=1))
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

        return run

    def errors(self, df: DataFrame) -> DataFrame:
        run = self._error_function(df.sparkSession)
        return apply_scores(df, run).drop("anomaly_label").withColumnRenamed("score", "error")

    def score(self, df: DataFrame) -> DataFrame:
        """Replaces ``features`` by ``score`` (minus the error) and ``anomaly_label``."""
        return self._judged(self.errors(df))

    def training_scores(self) -> DataFrame:
        """``(row_id, score, anomaly_label)`` of the training rows, from the errors that set the threshold."""
        return self._judged(self.training_errors)

    def _judged(self, scored: DataFrame) -> DataFrame:
        return scored.withColumn(
            "anomaly_label", F.when(F.col("error") > self.threshold, -1).otherwise(1)
        ).select(*[c for c in scored.columns if c != "error"], (-F.col("error")).alias("score"), "anomaly_label")

    def meta(self) -> dict:
        return {
            "scaler": self.scaler.meta(),
            "sizes": self.sizes,
            "weights": self.weights.tolist(),
            "params": self.params,
            "threshold": self.threshold,
            "history": self.history,
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
    def from_tables(cls, tables: dict, meta: dict) -> "Autoencoder":
        meta = dict(meta)
        return cls(
            scaler=VectorScaler.from_meta(meta.pop("scaler")),
            weights=np.array(meta.pop("weights")),
            **meta,
        )
