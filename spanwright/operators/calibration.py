"""Frame metrics and the choice of threshold and smoothing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.operators.segments import smoothed


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tp, fp, tn, fn; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = counts.withColumn("accuracy", ratio(tp + tn, tp + fp + tn + fn)).withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


def confusion(frames: DataFrame, predicted: Column, label: str = "label", by: tuple = ()) -> DataFrame:
    """Counts of the four outcomes, for each group of ``by``, with metrics."""
    on, true = F.coalesce(predicted, F.lit(False)), F.col(label) == 1
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    marked = frames.select(*by, on.alias("__on"), true.alias("__true"))
    p, t = F.col("__on"), F.col("__true")
    return metrics(marked.groupBy(*by).agg(count(p & t).alias("tp"), count(p & ~t).alias("fp"), count(~p & ~t).alias("tn"), count(~p & t).alias("fn")))


def threshold_grid(low: int = 5, high: int = 95) -> list[float]:
    return [k / 100 for k in range(low, high + 1)]


def sweep(frames: DataFrame, grid: list[float], score: str = "score", label: str = "label", by: tuple = ()) -> DataFrame:
    """Confusion and metrics at each threshold of an ascending grid.

    One pass: scores are put into the grid's cells and counted, and suffix
    sums over the few cells give every threshold; rows aren't multiplied.
    A null or NaN score is below every threshold.
    """
    value = F.nanvl(F.col(score).cast("double"), F.lit(None))
    # The number of thresholds at or below the score; a sorted literal array is searched by halves.
    edges = F.array(*map(F.lit, grid))
    cell = F.coalesce(F.aggregate(
        F.lit([1 << i for i in reversed(range((len(grid)).bit_length()))]),
        F.lit(0),
        lambda at, width: F.when((at + width <= len(grid)) & (F.coalesce(F.get(edges, at + width - 1), F.lit(float("inf"))) <= value), at + width).otherwise(at),
    ), F.lit(0))
    counts = frames.select(*by, cell.alias("cell"), (F.col(label) == 1).cast("int").alias("y")).groupBy(*by, "cell").agg(F.sum("y").cast("long").alias("pos"), F.count("*").alias("n"))
    # At most one row for each cell and group from here on.
    rows = [(i + 1, t) for i, t in enumerate(grid)]
    steps = frames.sparkSession.createDataFrame(rows, "cell int, threshold double")
    groups = counts.select(*by).distinct() if by else None
    full = groups.crossJoin(F.broadcast(steps)) if by else steps
    below = counts.filter("cell = 0").withColumn("threshold", F.lit(None).cast("double"))
    every = full.join(counts, [*by, "cell"], "left").select(*by, "cell", "threshold", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("n", F.lit(0)).alias("n")).unionByName(below.select(*by, "cell", "threshold", "pos", "n"))
    down = Window.partitionBy(*by).orderBy(F.desc("cell")) if by else Window.orderBy(F.desc("cell"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    every = every.withColumn("tp", F.sum("pos").over(down)).withColumn("on", F.sum("n").over(down)).withColumn("p", F.sum("pos").over(whole)).withColumn("all", F.sum("n").over(whole))
    out = every.filter("cell > 0").select(*by, "threshold", "tp", (F.col("on") - F.col("tp")).alias("fp"), (F.col("all") - F.col("on") - F.col("p") + F.col("tp")).alias("tn"), (F.col("p") - F.col("tp")).alias("fn"))
    return metrics(out)


def best_threshold(swept: DataFrame, by: tuple = ()) -> DataFrame:
    """The threshold of the best F1, then recall, precision and nearness to 0.5; the lowest of equals."""
    order = [F.desc("f1"), F.desc("recall"), F.desc("precision"), F.abs(F.col("threshold") - 0.5), F.col("threshold")]
    if not by:
        return swept.orderBy(*order).limit(1)
    return swept.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__n = 1").drop("__n")


def window_grid(frames: DataFrame, windows: tuple = (1, 3, 5, 7), grid: list[float] | None = None, key: str = "video", time: str = "t") -> DataFrame:
    """The best threshold for each smoothing window; all windows share one exchange."""
    wide = frames
    for w in windows:
        wide = smoothed(wide, w, key, time, name=f"__w{w}")
    each = F.explode(F.array(*(F.struct(F.lit(w).alias("window"), F.col(f"__w{w}").alias("value")) for w in windows)))
    long = wide.select("label", each.alias("x")).select("label", "x.window", "x.value")
    return best_threshold(sweep(long, grid or threshold_grid(), "value", by=("window",)), by=("window",))


def best_window(grid: DataFrame) -> DataFrame:
    """The best row of window_grid; the smaller window of equals."""
    return grid.orderBy(F.desc("f1"), F.desc("recall"), F.desc("precision"), F.abs(F.col("threshold") - 0.5), "window").limit(1)


def class_weights(frames: DataFrame, label: str = "label") -> DataFrame:
    """n / (2 * count) of each label."""
    counts = frames.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", (total / (2 * F.col("n"))).alias("weight"))


def weighted_mean(rows: DataFrame, value: str, weight: str, by: tuple = ()) -> DataFrame:
    return rows.groupBy(*by).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"))
