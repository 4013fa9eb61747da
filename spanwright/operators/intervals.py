"""Intervals: labels by containment, grids, overlap, ordered matching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from pyspark.sql.window import Window


def overlap(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(end_a, end_b) - F.greatest(start_a, start_b))


def iou(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    both = overlap(start_a, end_a, start_b, end_b)
    either = (end_a - start_a) + (end_b - start_b) - both
    return F.when((both > 0) & (either > 0), both / either).otherwise(F.lit(0.0))


def labelled(points: DataFrame, ranges: DataFrame, key: str = "video", time: str = "t", name: str = "label") -> DataFrame:
    """1 where a point lies in a half-open range of its key, else 0.

    A point is in some range if the latest end of the ranges that start by then
    is after it.  The starts and latest ends of a key travel as one sorted
    array, in which each point is found by halves; so the join is on the key
    alone, and no pair of point and range becomes a row.
    """
    order = Window.partitionBy(key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    reached = ranges.filter("end > start").select(key, "start", F.max("end").over(order).alias("reach"))
    held = reached.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "reach"))).alias("__ranges"))
    n, t = F.size("__ranges"), F.col(time)
    # The powers of two up to the number of ranges, largest first.
    held = held.withColumn("__steps", F.transform(F.sequence(F.floor(F.log2(n.cast("double"))).cast("int"), F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int")))
    begun = F.aggregate(
        "__steps",
        F.lit(0),
        lambda at, step: F.when((step <= n - at) & F.coalesce(F.get("__ranges", at + step - 1)["start"] <= t, F.lit(False)), at + step).otherwise(at),
    )
    inside = F.get("__ranges", begun - 1)["reach"] > t
    return points.join(held, key, "left").withColumn(name, F.coalesce(inside, F.lit(False)).cast("int")).drop("__ranges", "__steps")


def time_grid(windows: DataFrame, per_second: float, start: str = "start", end: str = "end") -> DataFrame:
    """Each window's sample times: start + i / per_second before the end; index from 1."""
    last = F.ceil((F.col(end) - F.col(start)) * per_second - 1e-9).cast("int") - 1
    rows = windows.filter(last >= 0).withColumn("__i", F.explode(F.sequence(F.lit(0), last)))
    at = F.round(F.col(start) + F.col("__i") / per_second, 6)
    return rows.withColumn("frame_index", (F.col("__i") + 1).cast("int")).withColumn("t", F.round(at, 3)).filter(at < F.col(end)).drop("__i")


def best_matching(truths: list[tuple], predictions: list[tuple]) -> dict[int, int]:
    """Order-preserving pairs of overlapping intervals with the largest sum of IoU.

    Sums are compared rounded to 12 digits, then by their number of pairs; of
    equals the earlier of leaving out the truth, leaving out the prediction
    and pairing them stays.  Back-pointers, so time and space are n * m.
    """
    n, m = len(truths), len(predictions)
    best = [[(0.0, 0)] * (m + 1) for _ in range(n + 1)]
    step = [[""] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            value, move = best[i - 1][j], "truth"
            rank = (round(value[0], 12), value[1])
            other = best[i][j - 1]
            if (round(other[0], 12), other[1]) > rank:
                value, move, rank = other, "prediction", (round(other[0], 12), other[1])
            (s, e), (p, q) = truths[i - 1], predictions[j - 1]
            both = max(0.0, min(e, q) - max(s, p))
            either = (e - s) + (q - p) - both
            if both > 0 and either > 0:
                total = best[i - 1][j - 1][0] + both / either
                pairs = best[i - 1][j - 1][1] + 1
                if (round(total, 12), pairs) > rank:
                    value, move = (total, pairs), "pair"
            best[i][j], step[i][j] = value, move
    found, i, j = {}, n, m
    while i and j:
        if step[i][j] == "pair":
            found[i - 1] = j - 1
            i, j = i - 1, j - 1
        elif step[i][j] == "truth":
            i -= 1
        else:
            j -= 1
    return found


def blocks(truths: DataFrame, predictions: DataFrame, key: str = "video") -> DataFrame:
    """(key, side, number, start, end, block) of truths (side 0) and predictions (1).

    Intervals of different blocks of a key don't overlap, so pairs and matchings
    are found for each block by itself.  ``number`` counts a side's intervals in
    the order of time, from 1.
    """
    side = lambda frame, i: frame.select(key, F.lit(i).alias("side"), *(F.col(c).cast("double").alias(c) for c in ("start", "end")))
    order = Window.partitionBy(key).orderBy("start", "end", "side")
    fresh = F.coalesce(F.col("start") >= F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    rows = side(truths, 0).unionByName(side(predictions, 1)).withColumn("fresh", fresh.cast("int"))
    rows = rows.withColumn("block", F.sum("fresh").over(order)).drop("fresh")
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(key, "side").orderBy("start", "end")))


@F.pandas_udf(ArrayType(IntegerType()))
def _partners(s: pd.Series, e: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
    """For each truth of a block, the place of its prediction, or -1; null for null."""

    def partners(*sides: np.ndarray | None) -> list[int] | None:
        if sides[0] is None:
            return None
        s, e, p, q = (x.tolist() for x in sides)
        found = best_matching(list(zip(s, e)), list(zip(p, q)))
        return [found.get(i, -1) for i in range(len(s))]

    return pd.Series([partners(*row) for row in zip(s, e, p, q)])


def aligned(truths: DataFrame, predictions: DataFrame, key: str = "video") -> DataFrame:
    """A row for each truth with its prediction of the best ordered matching, if
    any, and for each prediction without a truth; indices from 1 in time.

    ``truths`` and ``predictions`` have (key, start, end).  Only a block of
    overlapping intervals meets in a row, and only those of three or more are
    matched in Python.
    """
    item = lambda i: F.sort_array(F.collect_list(F.when(F.col("side") == i, F.struct("number", "start", "end"))))
    found = blocks(truths, predictions, key).groupBy(key, "block").agg(item(0).alias("t"), item(1).alias("p"))
    simple = (F.size("t") == 0) | (F.size("p") == 0) | (F.size("t") + F.size("p") == 2)
    alone = F.transform("t", lambda x, i: F.when(F.size("p") > i, i).otherwise(-1))
    chosen = _partners(*(F.when(~simple, F.col(c)) for c in ("t.start", "t.end", "p.start", "p.end")))
    found = found.withColumn("m", F.when(simple, alone).otherwise(chosen))
    pair = lambda x, y: F.struct(x.alias("t"), y.alias("p"))
    none = F.lit(None).cast("struct<number:int,start:double,end:double>")
    of_truths = F.transform("t", lambda x, i: pair(x, F.when(F.get("m", i) >= 0, F.get("p", F.get("m", i)))))
    others = F.filter(F.transform("p", lambda y, j: F.when(~F.array_contains("m", j), pair(none, y))), lambda r: r.isNotNull())
    rows = found.select(key, F.explode(F.concat(of_truths, others)).alias("r"))
    parts = [(f"{n}_{c}", f"r.{s}.{o}") for s, n in (("t", "truth"), ("p", "prediction")) for c, o in (("index", "number"), ("start", "start"), ("end", "end"))]
    return rows.select(key, *(F.col(path).alias(name) for name, path in parts))


def matched(truths: DataFrame, predictions: DataFrame, key: str = "video") -> DataFrame:
    """(key, truth_index, prediction_index) of the best ordered matching, from 1."""
    return aligned(truths, predictions, key).filter("truth_index is not null and prediction_index is not null").select(key, "truth_index", "prediction_index")


def overlap_faults(ranges: DataFrame, key: str = "video", order: tuple = ("start", "end")) -> DataFrame:
    """Ranges that start before one before them ends, in order of starts."""
    before = F.max("end").over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return ranges.withColumn("__before", before).filter("start < __before").drop("__before")
