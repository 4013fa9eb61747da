"""Model inference behind interfaces: a scorer of vectors, a recogniser of images.

No image model is part of this package.  ``Scorer`` and ``Recognizer`` are what
a caller implements; they are made once for each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Scorer(Protocol):
    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """Scores (0 to 1) of a batch of feature vectors."""


class Recognizer(Protocol):
    def __call__(self, images: list[str]) -> list[tuple[list[str], list[float], list[list[int]]]]:
        """Texts, scores and boxes of each image."""


#: Fixed keys of a checkpoint's parameters.
CHECKPOINT = ("architecture", "image_size", "threshold", "raw_threshold", "smoothing_window", "weights")


def checked_checkpoint(values: dict, architecture: str) -> dict:
    if missing := sorted(set(CHECKPOINT) - set(values)):
        raise ValueError(f"missing in the checkpoint: {missing}")
    if values["architecture"] != architecture:
        raise ValueError(f"the checkpoint is of {values['architecture']}, not {architecture}")
    if values["smoothing_window"] < 1 or values["smoothing_window"] % 2 == 0:
        raise ValueError("the smoothing window must be odd and positive")
    return values


def linear_score(vector: Column, weights: list[float], bias: float = 0.0) -> Column:
    """The dot product with fixed weights, in the JVM."""
    products = F.zip_with(vector, F.array(*map(F.lit, map(float, weights))), lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p) + F.lit(float(bias))


def positive_share(zero: Column, one: Column) -> Column:
    """Softmax of two logits, of the second."""
    return 1 / (1 + F.exp(zero - one))


def scored(frames: DataFrame, make: Callable[[], Scorer], vector: str = "features", name: str = "score") -> DataFrame:
    """The frames with a score from a model that each task makes once."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            values = model(np.stack(batch[vector].to_numpy())) if len(batch) else np.empty(0)
            yield batch.assign(**{name: np.asarray(values, "float32")})

    return frames.mapInPandas(score, frames.withColumn(name, F.lit(0).cast("float")).schema)


def recognised(images: DataFrame, make: Callable[[], Recognizer], path: str = "frame_path", batch_size: int = 8) -> DataFrame:
    """The images with texts, scores and boxes, in small batches; counts must agree."""

    def recognise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size]
                found = model(list(part[path]))
                if len(found) != len(part):
                    raise ValueError(f"{len(found)} results for {len(part)} images")
                texts, scores, boxes = zip(*found, strict=True)
                yield part.assign(texts=list(texts), scores=list(scores), boxes=list(boxes))

    extra = "texts array<string>, scores array<double>, boxes array<array<int>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema) + ", " + extra
    return images.mapInPandas(recognise, schema)


def decided(frames: DataFrame, threshold: float, raw_threshold: float, float32: bool = False) -> DataFrame:
    """Raw and smoothed decisions at inclusive thresholds; null scores are 0."""
    kind = "float" if float32 else "double"
    on = lambda c, t: F.coalesce(F.nanvl(F.col(c).cast(kind), F.lit(None)) >= F.lit(t).cast(kind), F.lit(False)).cast("int")
    return frames.withColumn("raw_pred_label", on("score", raw_threshold)).withColumn("pred_label", on("smoothed_score", threshold))
