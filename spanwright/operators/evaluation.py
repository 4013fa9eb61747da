"""Segment metrics: matched details, by series, overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.operators.calibration import ratio
from spanwright.operators.intervals import aligned, blocks, iou, overlap


def of_split(rows: DataFrame, split: str, column: str = "split") -> DataFrame:
    """The rows of a split; ``all``, in any case, keeps every row.  None raises."""
    found = rows if split.lower() == "all" else rows.filter(F.col(column) == split)
    if not found.limit(1).count():
        raise ValueError(f"no rows of split {split}")
    return found


def iou_pairs(truths: DataFrame, predictions: DataFrame, key: str = "video") -> DataFrame:
    """Overlapping pairs of truths and predictions of one key, with their IoU."""
    rows = blocks(truths, predictions, key)
    a = rows.filter("side = 0").select(key, "block", F.col("number").alias("truth_index"), F.col("start").alias("s"), F.col("end").alias("e"))
    b = rows.filter("side = 1").select(key, "block", F.col("number").alias("prediction_index"), F.col("start").alias("p"), F.col("end").alias("q"))
    value = iou(*(F.col(c) for c in ("s", "e", "p", "q")))
    return a.join(b, [key, "block"]).filter("s < q and p < e").select(key, "truth_index", "prediction_index", value.alias("iou"))


def details(truths: DataFrame, predictions: DataFrame, least_iou: float = 0.5, split: str = "all", key: str = "video") -> DataFrame:
    """A row for each truth, and for each prediction that matched none.

    Status: detected, below_iou_threshold, missed or extra_prediction.
    """
    rows = aligned(truths, predictions, key)
    has = F.col("prediction_start").isNotNull()
    value = F.coalesce(F.when(has & F.col("truth_start").isNotNull(), iou(*(F.col(c) for c in ("truth_start", "truth_end", "prediction_start", "prediction_end")))), F.lit(0.0))
    status = (
        F.when(F.col("truth_index").isNull(), "extra_prediction").when(~has, "missed").when(F.col("temporal_iou") >= least_iou, "detected").otherwise("below_iou_threshold")
    )
    return rows.withColumn("temporal_iou", value).select(
        F.lit(split).alias("split"), key, "truth_index", status.alias("status"), (status == "detected").alias("detected"), "truth_start", "truth_end",
        "prediction_index", "prediction_start", "prediction_end",
        (F.col("prediction_start") - F.col("truth_start")).alias("start_error"), (F.col("prediction_end") - F.col("truth_end")).alias("end_error"), "temporal_iou",
    )


def _gaps(truths: Column, predictions: Column) -> tuple[Column, Column]:
    """Time between consecutive truths, and how much of it is predicted, of a
    key's sorted truths and its predictions, arrays of struct(start, end)."""
    between = F.transform(F.slice(truths, 2, F.greatest(F.size(truths) - 1, F.lit(0))), lambda t, i: F.struct(F.get(truths, i)["end"].alias("g"), t["start"].alias("h")))
    covered = lambda b: F.aggregate(predictions, F.lit(0.0), lambda s, p: s + overlap(b["g"], b["h"], p["start"], p["end"]))
    total = lambda value: F.aggregate(between, F.lit(0.0), lambda s, b: s + value(b))
    return total(lambda b: F.greatest(F.lit(0.0), b["h"] - b["g"])), total(covered)


def _rates(frame: DataFrame) -> DataFrame:
    frame = frame.withColumn("false_positive_segments", F.col("predicted_segments") - F.col("detected_segments")).withColumn("missed_segments", F.col("truth_segments") - F.col("detected_segments"))
    frame = frame.withColumn("segment_precision", ratio(F.col("detected_segments"), F.col("predicted_segments"))).withColumn("segment_recall", ratio(F.col("detected_segments"), F.col("truth_segments")))
    p, r = F.col("segment_precision"), F.col("segment_recall")
    frame = frame.withColumn("segment_f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))
    return frame.withColumn("gap_preservation", F.when(F.col("gap_duration") > 0, 1 - F.col("gap_false_positive") / F.col("gap_duration")))


#: Sums that make up the means: over all truths, or over the detected ones.
_MEANS = {"mean_iou_all": ("temporal_iou", False), "mean_iou_detected": ("temporal_iou", True), "start_mae": ("start_error", True), "end_mae": ("end_error", True)}


def _means() -> dict:
    count = {False: "truth_segments", True: "detected_segments"}
    return {name: F.try_divide(F.col(f"__{name}"), F.col(count[detected])) for name, (_, detected) in _MEANS.items()}


def by_series(found: DataFrame, key: str = "video", keys: DataFrame | None = None, split: str = "all", sums: bool = False) -> DataFrame:
    """Counts, rates, errors and gap figures of each key, of its details(); null where undefined.

    With ``keys`` (key), keys with neither truth nor prediction have a row of ``split`` too.
    ``sums`` keeps the columns that overall() needs.
    """
    truth, seen = F.col("truth_index").isNotNull(), F.col("detected")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    total = lambda c, detected: F.coalesce(F.sum(F.when(seen if detected else truth, F.abs(c))), F.lit(0.0))
    counts = ["truth_segments", "predicted_segments", "detected_segments"]
    part = lambda n: F.sort_array(F.collect_list(F.when(F.col(f"{n}_index").isNotNull(), F.struct(F.col(f"{n}_start").alias("start"), F.col(f"{n}_end").alias("end")))))
    out = found.groupBy("split", key).agg(
        count(truth).alias(counts[0]), count(F.col("prediction_index").isNotNull()).alias(counts[1]), count(seen).alias(counts[2]),
        *(total(c, detected).alias(f"__{name}") for name, (c, detected) in _MEANS.items()), part("truth").alias("__t"), part("prediction").alias("__p"),
    )
    duration, covered = _gaps(F.col("__t"), F.col("__p"))
    out = out.withColumn("gap_duration", duration).withColumn("gap_false_positive", covered).drop("__t", "__p")
    if keys is not None:
        out = keys.select(key).distinct().join(out, key, "left").withColumn("split", F.coalesce("split", F.lit(split)))
        out = out.fillna(0, counts).fillna(0.0, ["gap_duration", "gap_false_positive", *(f"__{name}" for name in _MEANS)])
    out = _rates(out.withColumns(_means()))
    whole = F.col("detected_segments") == F.col("truth_segments")
    out = out.withColumn("all_detected", whole).withColumn("exact_detection", whole & (F.col("false_positive_segments") == 0))
    return out if sums else out.drop(*(f"__{name}" for name in _MEANS))


def overall(series: DataFrame) -> DataFrame:
    """One row for each split, of by_series() with its sums: sums of counts, rates
    of the sums, means over segments."""
    flags = [F.sum(F.col(c).cast("long")).alias(n) for c, n in (("all_detected", "series_all_detected"), ("exact_detection", "series_exact_detection"))]
    names = ["truth_segments", "predicted_segments", "detected_segments", "gap_duration", "gap_false_positive", *(f"__{name}" for name in _MEANS)]
    sums = series.groupBy("split").agg(F.count("*").alias("n_series"), *(F.sum(c).alias(c) for c in names), *flags)
    return _rates(sums.withColumns(_means())).drop(*(f"__{name}" for name in _MEANS))
