"""Training a binary classifier of feature vectors: logistic regression in stages.

Gradients are sums over rows, so every epoch is one aggregate in Spark; only
sums as long as a vector come to the driver.  Classes are weighted by
n / (2 * count).  After an epoch the validation rows are scored at all
thresholds of a grid; the epoch of the best (F1, recall, precision) stays, and
a stage ends early after ``patience`` epochs without a better one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwright.operators.calibration import best_threshold, class_weights, sweep, threshold_grid
from spanwright.operators.scoring import linear_score


@dataclass
class EarlyStop:
    """Whether to go on after each value; values are compared as tuples."""

    patience: int
    best: tuple | None = None
    misses: int = 0

    def improved(self, value: tuple) -> bool:
        better = self.best is None or value > self.best
        self.best, self.misses = (value, 0) if better else (self.best, self.misses + 1)
        return better

    @property
    def over(self) -> bool:
        return self.misses >= self.patience


@dataclass
class Stage:
    """Epochs with one rate; ``parts`` are the places of the weights that move, all unless given."""

    epochs: int
    rate: float
    parts: tuple[int, ...] | None = None


@dataclass
class Trained:
    weights: list[float]
    bias: float
    threshold: float
    metrics: tuple[float, float, float]
    epochs: list[dict] = field(default_factory=list)


def jittered(vectors: np.ndarray, keys: np.ndarray, seed: int, brightness: float = 0.1, contrast: float = 0.1) -> np.ndarray:
    """Vectors with their level and spread changed a little, by a hash of key and seed.

    The same key and seed give the same change in any task, so a task that is
    run again after a lost executor gives the same sums.
    """
    out = np.empty_like(vectors)
    for i, key in enumerate(keys):
        level, spread = np.random.default_rng([seed, int(key) & 0xFFFFFFFF]).uniform(-1, 1, 2)
        middle = vectors[i].mean()
        out[i] = (vectors[i] - middle) * (1 + contrast * spread) + middle + brightness * level
    return out


def normalised(vectors: DataFrame, column: str = "features") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The rows with each place of the vector brought to mean 0 and deviation 1; mean and deviation."""
    rows = vectors.select(F.posexplode(F.col(column)).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()
    mean, spread = np.array([r.m for r in rows], float), np.array([r.s or 1.0 for r in rows], float)
    if not rows:
        return vectors, mean, spread
    parts = F.array(*(F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(mean, spread)))
    return vectors.withColumn(column, F.zip_with(column, parts, lambda x, p: (x.cast("double") - p["m"]) / p["s"])), mean, spread


def _gradient(rows: DataFrame, weights: np.ndarray, bias: float, balance: dict[int, float], seed: int | None) -> tuple[np.ndarray, float, float]:
    """Sums over (key, features, label) of the loss's slope by weights and bias, and of the class weights."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, by_bias, total = np.zeros(len(weights)), 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column(1).to_pylist(), float)
            if seed is not None:
                x = jittered(x, batch.column(0).to_numpy(zero_copy_only=False), seed)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            w = np.array([balance[int(v)] for v in y])
            error = w * (1 / (1 + np.exp(-(x @ weights + bias))) - y)
            slope, by_bias, total = slope + error @ x, by_bias + error.sum(), total + w.sum()
        yield pa.RecordBatch.from_pydict({"slope": [slope.tolist()], "bias": [by_bias], "total": [total]})

    parts = rows.mapInArrow(sums, "slope array<double>, bias double, total double")
    # One row for each task, summed place by place before it comes to the driver.
    each = parts.select(F.posexplode(F.concat("slope", F.array("bias", "total"))).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    values = np.array([r.x for r in sorted(each.collect())])
    return values[:-2], float(values[-2]), float(values[-1])


def train(
    train_rows: DataFrame, val_rows: DataFrame, stages: Iterable[Stage], patience: int = 4, seed: int = 42, augment: bool = False,
    key: str = "id", vector: str = "features", label: str = "label", decay: float = 1e-4,
) -> Trained:
    """Fit on rows of (key, vector, label 0 or 1); both labels must be there.

    Weights start at 0, so equal rows, options and seed give equal results up
    to the order of sums.  The threshold is the best on the validation rows.
    """
    rows = train_rows.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("features"), F.col(label).cast("int").alias("label"))
    balance = {r["label"]: r["weight"] for r in class_weights(rows).collect()}
    if set(balance) != {0, 1}:
        raise ValueError(f"training needs rows of both labels, not {sorted(balance)}")
    first = rows.select(F.size("features")).first()[0]
    weights, bias, best = np.zeros(first), 0.0, None
    epochs: list[dict] = []
    for number, stage in enumerate(stages):
        moved = np.zeros(first)
        moved[list(range(first) if stage.parts is None else stage.parts)] = 1
        m, v, mb, vb = np.zeros(first), np.zeros(first), 0.0, 0.0
        stop = EarlyStop(patience, best.metrics if best else None)
        for epoch in range(1, stage.epochs + 1):
            slope, by_bias, total = _gradient(rows, weights, bias, balance, seed + len(epochs) if augment else None)
            g, gb = moved * slope / total, by_bias / total
            m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            correct = np.sqrt(1 - 0.999**epoch) / (1 - 0.9**epoch)
            weights = weights * (1 - stage.rate * decay * moved) - stage.rate * correct * m / (np.sqrt(v) + 1e-8)
            bias -= stage.rate * correct * mb / (np.sqrt(vb) + 1e-8)
            found = best_threshold(sweep(scored(val_rows, weights, bias, vector), threshold_grid(), label=label)).first()
            value = (found["f1"], found["recall"], found["precision"])
            epochs.append({"stage": number, "epoch": epoch, "threshold": found["threshold"], "f1": value[0], "recall": value[1], "precision": value[2]})
            if stop.improved(value):
                best = Trained(weights.tolist(), float(bias), found["threshold"], value)
            if stop.over:
                break
    if best is None:
        raise ValueError("no epoch to train")
    best.epochs = epochs
    return best


def scored(rows: DataFrame, weights, bias: float, vector: str = "features", name: str = "score") -> DataFrame:
    """The rows with the probability of label 1, in the JVM."""
    return rows.withColumn(name, 1 / (1 + F.exp(-linear_score(F.col(vector), list(map(float, weights)), float(bias)))))
