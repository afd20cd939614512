"""Model state: a table with one small row per model and version; the latest version counts."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.operators.sides import latest_by
from ticktide.schemas import FEATURE_COLUMNS, MODEL_STATE

WIDTH = len(FEATURE_COLUMNS)


@dataclass
class ModelState:
    """Weights plus the running mean and spread (sum of squared deviations) of the raw features."""

    model: str
    version: int = -1
    step: int = 0
    seen: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    moments: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))

    @property
    def fitted(self) -> bool:
        return self.step > 0

    def scale(self) -> np.ndarray:
        """Standard deviation per feature; 1 where a feature has not varied yet."""
        deviation = np.sqrt(self.spread / max(self.seen, 1))
        return np.where(deviation > 0, deviation, 1.0)

    def observe(self, n: int, mean: np.ndarray, spread: np.ndarray) -> None:
        """Merge the feature statistics of another batch."""
        total = self.seen + n
        shift = mean - self.mean
        self.spread = self.spread + spread + shift**2 * (self.seen * n / total)
        self.mean = self.mean + shift * (n / total)
        self.seen = total


def to_frame(spark: SparkSession, states: list[ModelState]) -> DataFrame:
    rows = [
        (s.model, s.version, s.step, s.seen, *[[float(v) for v in part] for part in (s.weights, s.moments, s.mean, s.spread)])
        for s in states
    ]
    return spark.createDataFrame(rows, MODEL_STATE)


def latest_models(states: DataFrame) -> DataFrame:
    """The newest version of each model."""
    return latest_by(states, ["model"], F.col("version"))


def load(states: DataFrame, model: str) -> ModelState | None:
    """Newest state of one model; None when it was never saved, that is, when it is not fitted."""
    row = latest_models(states.where(F.col("model") == model)).first()
    if row is None:
        return None
    arrays = {name: np.array(row[name]) for name in ("weights", "moments", "mean", "spread")}
    return ModelState(row["model"], row["version"], row["step"], row["seen"], **arrays)
