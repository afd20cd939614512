"""Online regressors. Spark sums errors and gradients over a batch; the driver only holds the weights.

A learner takes one step per batch: ``gradient`` is a distributed aggregate whose size depends on the
model alone, ``step`` applies it to the weights.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ticktide.models.state import ModelState
from ticktide.schemas import FEATURE_COLUMNS
from ticktide.session import scratch_path


@dataclass
class Gradient:
    """Means over a batch: the gradient of half the squared error, and the squared error itself."""

    values: np.ndarray
    squared_error: float


def feature_stats(features: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, mean and sum of squared deviations per feature, in one pass."""
    raw = [F.col(name).cast("double") for name in FEATURE_COLUMNS]
    row = features.agg(
        F.count(F.lit(1)), *[F.avg(value) for value in raw], *[F.var_pop(value) for value in raw]
    ).first()
    n, width = row[0], len(FEATURE_COLUMNS)
    if not n:
        return 0, np.zeros(width), np.zeros(width)
    return n, np.array(row[1:1 + width]), np.array(row[1 + width:]) * n


@dataclass
class LinearLearner:
    """Linear regression by stochastic gradient descent; 17 weights and an intercept."""

    name: str = "sgd"
    rate: float = 0.01
    power: float = 0.25
    penalty: float = 1e-4

    def start(self) -> ModelState:
        return ModelState(self.name, weights=np.zeros(len(FEATURE_COLUMNS) + 1))

    def predict(self, features: DataFrame, state: ModelState) -> DataFrame:
        """The weights belong to standardised inputs; folding mean and scale into them leaves raw columns."""
        slopes = state.weights[:-1] / state.scale()
        base = state.weights[-1] - slopes @ state.mean
        terms = (F.col(name).cast("double") * F.lit(float(slope)) for name, slope in zip(FEATURE_COLUMNS, slopes))
        return features.withColumn("y_hat", sum(terms, F.lit(float(base))))

    def gradient(self, features: DataFrame, state: ModelState) -> Gradient:
        """One native aggregate over the batch: moments of the error with the raw inputs."""
        errors = self.predict(features, state).withColumn("error", F.col("y_hat") - F.col("y"))
        error = F.col("error")
        row = errors.agg(
            *[F.avg(error * F.col(name)) for name in FEATURE_COLUMNS], F.avg(error), F.avg(error * error)
        ).first()
        with_inputs, mean_error = np.array(row[:-2]), row[-2]
        slopes = (with_inputs - state.mean * mean_error) / state.scale()
        return Gradient(np.append(slopes, mean_error), row[-1])

    def step(self, state: ModelState, gradient: Gradient) -> None:
        state.step += 1
        decay = np.append(np.full(len(FEATURE_COLUMNS), self.penalty), 0.0)
        rate = self.rate / state.step**self.power
        state.weights = state.weights - rate * (gradient.values + decay * state.weights)


def _passes():
    """Forward and backward pass as closures: they travel to the workers whole, which need not have this
    package installed."""

    def forward(x: np.ndarray, layers: list[np.ndarray]) -> list[np.ndarray]:
        """Inputs of every layer, then the output."""
        values = [x]
        for at, layer in enumerate(layers):
            out = values[-1] @ layer[:-1] + layer[-1]
            values.append(out if at == len(layers) - 1 else np.maximum(out, 0.0))
        return values

    def sums(x: np.ndarray, y: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
        """Gradient sums over rows in weight order, then the sum of squared errors and the row count."""
        values = forward(x, layers)
        error = values[-1] - y[:, None]
        parts, delta = [], error
        for at in range(len(layers) - 1, -1, -1):
            parts.append(np.vstack([values[at].T @ delta, delta.sum(axis=0)]).ravel())
            if at:
                delta = (delta @ layers[at][:-1].T) * (values[at] > 0)
        return np.concatenate([*parts[::-1], [float((error**2).sum()), float(len(y))]])

    return forward, sums


forward_pass, gradient_sums = _passes()


@dataclass
class NetworkLearner:
    """Multi-layer perceptron regressor, rectified hidden layers, trained with Adam.

    Each partition runs forward and backward over its Arrow batches and returns one vector of sums;
    Spark adds those vectors up by position.
    """

    name: str = "mlp"
    hidden: tuple[int, ...] = (25, 50, 25)
    seed: int = 7
    rate: float = 1e-3
    penalty: float = 1e-4
    betas: tuple[float, float] = (0.9, 0.999)
    epsilon: float = 1e-8
    shapes: list[tuple[int, int]] = field(init=False)

    def __post_init__(self) -> None:
        sizes = [len(FEATURE_COLUMNS), *self.hidden, 1]
        self.shapes = list(zip(sizes, sizes[1:]))

    @property
    def size(self) -> int:
        return sum((rows + 1) * columns for rows, columns in self.shapes)

    def start(self) -> ModelState:
        draw = np.random.default_rng(self.seed)
        weights = [
            draw.uniform(-1, 1, (rows + 1) * columns) * np.sqrt(6.0 / (rows + columns)) for rows, columns in self.shapes
        ]
        return ModelState(self.name, weights=np.concatenate(weights), moments=np.zeros(2 * self.size))

    def layers(self, weights: np.ndarray) -> list[np.ndarray]:
        """Weight matrices with the bias as last row."""
        ends = np.cumsum([(rows + 1) * columns for rows, columns in self.shapes])
        parts = np.split(weights, ends[:-1])
        return [part.reshape(rows + 1, columns) for part, (rows, columns) in zip(parts, self.shapes)]

    def predict(self, features: DataFrame, state: ModelState) -> DataFrame:
        layers, mean, scale = self.layers(state.weights), state.mean, state.scale()

        forward = forward_pass

        @F.pandas_udf("double")
        def predicted(x: pd.Series) -> pd.Series:
            return pd.Series(forward((np.stack(x.to_numpy()) - mean) / scale, layers)[-1][:, 0])

        inputs = F.array(*[F.col(name).cast("double") for name in FEATURE_COLUMNS])
        return features.withColumn("y_hat", predicted(inputs))

    def gradient(self, features: DataFrame, state: ModelState) -> Gradient:
        layers, mean, scale = self.layers(state.weights), state.mean, state.scale()

        sums, columns = gradient_sums, FEATURE_COLUMNS

        def partition_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                if len(batch):
                    x = (batch[columns].to_numpy(dtype=float) - mean) / scale
                    part = sums(x, batch["y"].to_numpy(dtype=float), layers)
                    total = part if total is None else total + part
            if total is not None:
                yield pd.DataFrame({"at": np.arange(len(total)), "value": total})

        added = (
            features.select(*FEATURE_COLUMNS, "y")
            .mapInPandas(partition_sums, "at bigint, value double")
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
        )
        # One row per weight: the model's size, not the data's, bounds what reaches the driver.
        totals = np.array([row["value"] for row in added.orderBy("at").collect()])
        rows = totals[-1]
        return Gradient(totals[:-2] / rows, totals[-2] / rows)

    def step(self, state: ModelState, gradient: Gradient) -> None:
        state.step += 1
        decay = np.concatenate([
            np.append(np.full(rows * columns, self.penalty), np.zeros(columns)) for rows, columns in self.shapes
        ])
        slope = gradient.values + decay * state.weights
        first, second = np.split(state.moments, 2)
        first = self.betas[0] * first + (1 - self.betas[0]) * slope
        second = self.betas[1] * second + (1 - self.betas[1]) * slope**2
        bias = np.sqrt(1 - self.betas[1] ** state.step) / (1 - self.betas[0] ** state.step)
        state.weights = state.weights - self.rate * bias * first / (np.sqrt(second) + self.epsilon)
        state.moments = np.concatenate([first, second])


def train(features: DataFrame, learner: LinearLearner | NetworkLearner, state: ModelState) -> tuple[ModelState, Gradient | None]:
    """Test then train on one batch. The returned error is that of the weights before the step.

    Features are standardised with what was known before the batch, or, the first time, with the batch.
    """
    n, mean, spread = feature_stats(features)
    if not n:
        return state, None
    if not state.seen:
        state.observe(n, mean, spread)
        gradient = learner.gradient(features, state)
    else:
        gradient = learner.gradient(features, state)
        state.observe(n, mean, spread)
    learner.step(state, gradient)
    return state, gradient


def train_minibatches(
    features: DataFrame,
    learner: LinearLearner | NetworkLearner,
    state: ModelState,
    rows_per_step: int = 100_000,
    steps: int | None = None,
    key: str = "event_id",
    seed: int = 7,
) -> tuple[ModelState, Gradient | None]:
    """Test then train on one batch in several steps, each on its own rows, so that a batch of many rows counts as many.

    The rows are dealt into about n / ``rows_per_step`` parts by a seeded hash of ``key``, which is the same in a replay, and
    written once; a step reads only its part. Each part is tested with the weights of the steps before it, and the
    returned error is the mean of these over all rows. Features are standardised as in ``train``, once for the batch.
    """
    n, mean, spread = feature_stats(features)
    if not n:
        return state, None
    spark, path = features.sparkSession, scratch_path(features.sparkSession, "minibatches")
    steps = steps or max(1, -(-n // rows_per_step))
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary")), 1, 8), 16, 10).cast("bigint")
    parted = features.select(*FEATURE_COLUMNS, "y", (drawn % steps).alias("part"))
    parted.hint("rebalance", "part").write.partitionBy("part").parquet(path)
    parts = spark.read.parquet(path)
    sizes = {row["part"]: row["count"] for row in parts.groupBy("part").count().collect()}

    fresh = not state.seen
    if fresh:
        state.observe(n, mean, spread)
    squared = 0.0
    for part in sorted(sizes):
        gradient = learner.gradient(parts.where(F.col("part") == part), state)
        squared += gradient.squared_error * sizes[part]
        learner.step(state, gradient)
    if not fresh:
        state.observe(n, mean, spread)
    return state, Gradient(gradient.values, squared / n)
