"""From scored frames to segments: smoothing, islands, merging.

All windows share the partitioning by series, so one exchange serves a whole
chain.  Times are double seconds; segments are half-open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _series(key: str, time: str):
    return Window.partitionBy(key).orderBy(time)


def smoothed(frames: DataFrame, window: int, key: str = "video", time: str = "t", score: str = "score", name: str = "smoothed") -> DataFrame:
    """Centred mean over ``window`` (odd) rows; at the edges over those there are."""
    if window < 1 or window % 2 == 0:
        raise ValueError("window must be odd and positive")
    half = window // 2
    return frames.withColumn(name, F.avg(score).over(_series(key, time).rowsBetween(-half, half)))


def steps(frames: DataFrame, key: str = "video", time: str = "t", name: str = "step") -> DataFrame:
    """(key, step): the median of the positive time differences of a series; 0 without any."""
    gap = F.col(time) - F.lag(time).over(_series(key, time))
    marked = frames.select(key, gap.alias("__gap"))
    return marked.groupBy(key).agg(F.coalesce(F.median(F.when(F.col("__gap") > 0, F.col("__gap"))), F.lit(0.0)).alias(name))


def islands(frames: DataFrame, positive: Column, key: str = "video", time: str = "t") -> DataFrame:
    """(key, start, end) of the runs of positive rows.

    A run ends at the time of the row after it; a run at the end of its series
    ends one median step after its last row.  Null counts as not positive.
    """
    order = _series(key, time)
    rows = frames.select(key, time, F.coalesce(positive, F.lit(False)).alias("__on"), F.lead(time).over(order).alias("__next"))
    opened = F.col("__on") & ~F.coalesce(F.lag("__on").over(order), F.lit(False))
    rows = rows.withColumn("__run", F.sum(F.when(opened, 1).otherwise(0)).over(order))
    runs = rows.filter("__on").groupBy(key, "__run").agg(
        F.min(time).alias("start"), F.max("__next").alias("__upto"), F.max(F.when(F.col("__next").isNull(), F.col(time))).alias("__last")
    )
    end = F.greatest("__upto", F.col("__last") + F.col("step"))
    return runs.join(steps(frames, key, time), key).select(key, "start", end.alias("end"))


def merged(segments: DataFrame, gap: float = 0.0, least: float = 0.0, key: str = "video") -> DataFrame:
    """Join segments whose gap is at most ``gap``; then drop those under ``least``."""
    if gap < 0 or least < 0:
        raise ValueError("gap and least must not be negative")
    order = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("start") - reach > gap, F.lit(True))
    rows = segments.withColumn("__new", F.when(fresh, 1).otherwise(0)).withColumn("__group", F.sum("__new").over(order))
    out = rows.groupBy(key, "__group").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__group")
    return out.filter(F.col("end") - F.col("start") >= least)


def score_column(frame: DataFrame, threshold: float | None) -> tuple[str, float]:
    """The column that decides, and the bound: labels at 0.5 without a threshold."""
    if threshold is None:
        if "pred_label" not in frame.columns:
            raise ValueError("without a threshold, pred_label is needed")
        return "pred_label", 0.5
    for name in ("smoothed_score", "score", "pred_label"):
        if name in frame.columns:
            return name, threshold
    raise ValueError("no score column")


def segments_of(frames: DataFrame, threshold: float | None = None, gap: float = 0.0, least: float = 0.0, key: str = "video", time: str = "t") -> DataFrame:
    """The whole chain from decided or scored frames to merged segments."""
    name, bound = score_column(frames, threshold)
    return merged(islands(frames, F.col(name) >= bound, key, time), gap, least, key)


def order_faults(frames: DataFrame, key: str = "video", time: str = "t") -> DataFrame:
    """Rows whose time isn't finite, is negative, or doesn't exceed the one before."""
    before = F.lag(time).over(_series(key, time))
    t = F.col(time)
    bad = t.isNull() | F.isnan(t) | (t < 0) | (F.abs(t) == float("inf")) | (t <= before)
    return frames.withColumn("__bad", F.coalesce(bad, F.lit(False))).filter("__bad").drop("__bad")


def sessions(rows: DataFrame, gap: float, key: str = "video", time: str = "t") -> DataFrame:
    """(key, session, start, end, n): runs of rows at most ``gap`` apart."""
    order = _series(key, time)
    fresh = F.coalesce(F.col(time) - F.lag(time).over(order) > gap, F.lit(True))
    marked = rows.withColumn("__new", F.when(fresh, 1).otherwise(0)).withColumn("session", F.sum("__new").over(order))
    return marked.groupBy(key, "session").agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n"))
