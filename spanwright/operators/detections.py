"""Positioned text detections: filters, spatial joins, votes.

Detections have (video, frame_index, row_id, text, text_type, score, x, y); the
order of rows is that of ``row_id``, and ties go to the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.functions.text import NUMBER, SUBSTITUTES, is_shirt_number, text_type

FRAME = ("video", "frame_index")


def unnested(results: DataFrame, least: float = 0.8) -> DataFrame:
    """A row for each text of parallel arrays (texts, scores, boxes).

    Arrays of different lengths raise.  Empty texts and scores under ``least``
    are left out; centres are rounded to 3 digits, shares of the size to 6.
    """
    same = (F.size("texts") == F.size("scores")) & (F.size("texts") == F.size("boxes"))
    zipped = F.when(same, F.arrays_zip("texts", "scores", "boxes")).otherwise(F.raise_error(F.lit("arrays of different lengths")))
    kept = [c for c in results.columns if c not in ("texts", "scores", "boxes")]
    rows = results.select(*kept, F.posexplode(zipped).alias("detection_index", "d"))
    box = [F.element_at("d.boxes", i) for i in range(1, 5)]
    text = F.trim("d.texts")
    rows = rows.select(*kept, "detection_index", text.alias("text"), text_type(text).alias("text_type"), F.round("d.scores", 6).alias("score"), *(b.alias(n) for b, n in zip(box, ("x1", "y1", "x2", "y2"))))
    rows = rows.filter((F.col("text") != "") & (F.col("score") >= least))
    for a, size in (("x", "frame_width"), ("y", "frame_height")):
        rows = rows.withColumn(f"center_{a}", F.round((F.col(f"{a}1") + F.col(f"{a}2")) / 2, 3))
        if size in kept:
            rows = rows.withColumn(f"center_{a}_norm", F.round(F.col(f"center_{a}") / F.col(size), 6))
    return rows


def best_number(pairs: Column, least: float = 0.6) -> Column:
    """Of an array of struct(text, score): the numeric text of 1 to 99 of the best score; the first of equals."""
    fits = F.filter(pairs, lambda p: F.coalesce(p["text"].rlike("^[0-9]+$") & p["text"].try_cast("int").between(1, 99) & (p["score"] >= least), F.lit(False)))
    top = F.aggregate(fits, F.lit(None).cast("double"), lambda m, p: F.greatest(m, p["score"]))
    return F.get(F.filter(fits, lambda p: p["score"] == top), F.lit(0))


def before_substitutes(rows: DataFrame, norm: str = "norm", by: tuple = ("video",), time: str = "frame_index") -> DataFrame:
    """Rows earlier than the first text that names substitutes."""
    cut = F.min(F.when(F.col(norm).rlike(SUBSTITUTES), F.col(time))).over(Window.partitionBy(*by))
    return rows.withColumn("__cut", cut).filter(F.col("__cut").isNull() | (F.col(time) < F.col("__cut"))).drop("__cut")


def without_panel(rows: DataFrame, norm: str = "norm", by: tuple = FRAME) -> DataFrame:
    """Rows outside the panel of substitutes: 0.15 beyond its header, on the header's side."""
    head = F.median(F.when(F.col(norm).rlike(SUBSTITUTES), F.col("x"))).over(Window.partitionBy(*by))
    inside = F.when(F.col("__x") < 0.5, F.col("x") < F.col("__x") + 0.15).otherwise(F.col("x") > F.col("__x") - 0.15)
    return rows.withColumn("__x", head).filter(~F.coalesce(inside, F.lit(False))).drop("__x")


def numbers_of(rows: DataFrame) -> DataFrame:
    return rows.filter(is_shirt_number(F.col("text_type"), F.col("text")))


def names_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("text_type") != NUMBER)


def _near(left: DataFrame, right: DataFrame, band: Column, cost: Column, by: tuple = FRAME) -> DataFrame:
    """For each row of ``left`` (n_…) the cheapest of ``right`` (o_…) in its band."""
    a = left.select(*by, *(F.col(c).alias(f"n_{c}") for c in ("row_id", "text", "score", "x", "y")))
    b = right.select(*by, *(F.col(c).alias(f"o_{c}") for c in ("row_id", "text", "score", "x", "y")))
    first = Window.partitionBy(*by, "n_row_id").orderBy(F.col("cost"), F.col("o_row_id"))
    pairs = a.join(b, list(by)).filter(band).withColumn("cost", cost)
    return pairs.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def numbers_left_of_names(names: DataFrame, numbers: DataFrame, by: tuple = FRAME) -> DataFrame:
    """Each name's number: 0.015 to 0.25 to the left, within 0.022 of its height."""
    dx, dy = F.col("n_x") - F.col("o_x"), F.abs(F.col("n_y") - F.col("o_y"))
    return _near(names, numbers, dx.between(0.015, 0.25) & (dy <= 0.022), 5 * dy + dx, by)


def labels_under_numbers(numbers: DataFrame, names: DataFrame, by: tuple = FRAME) -> DataFrame:
    """Each number's label: within 0.07 sideways, 0.03 to 0.13 below."""
    dx, dy = F.abs(F.col("o_x") - F.col("n_x")), F.col("o_y") - F.col("n_y")
    return _near(numbers, names, (dx <= 0.07) & dy.between(0.03, 0.13), dx + F.abs(dy - 0.078), by)


def vertical_stacks(names: DataFrame, by: tuple = FRAME) -> DataFrame:
    """Pairs and triples of names of one frame in a compact vertical stack."""
    a, b, c = (names.select(*by, *(F.col(k).alias(f"{s}_{k}") for k in ("row_id", "text", "score", "x", "y"))) for s in "abc")
    two = a.join(b, list(by)).filter("a_row_id < b_row_id and abs(a_x - b_x) <= 0.065 and abs(a_y - b_y) <= 0.09")
    item = lambda s: F.struct(F.col(f"{s}_y").alias("y"), F.col(f"{s}_row_id").alias("row_id"), F.col(f"{s}_text").alias("text"), F.col(f"{s}_score").alias("score"))
    pairs = two.select(*by, F.sort_array(F.array(item("a"), item("b"))).alias("s"))
    # Of a stack of three, two members may be further apart than neighbours are.
    wide = a.join(b, list(by)).filter("a_row_id < b_row_id and abs(a_x - b_x) <= 0.065 and abs(a_y - b_y) <= 0.14")
    three = wide.join(c, list(by)).filter("b_row_id < c_row_id").filter("greatest(a_x, b_x, c_x) - least(a_x, b_x, c_x) <= 0.065 and greatest(a_y, b_y, c_y) - least(a_y, b_y, c_y) <= 0.14")
    triples = three.select(*by, F.sort_array(F.array(item("a"), item("b"), item("c"))).alias("s")).filter("s[1].y - s[0].y <= 0.09 and s[2].y - s[1].y <= 0.09")
    both = pairs.unionByName(triples)
    text = F.regexp_replace(F.array_join(F.transform("s", lambda r: F.trim(r["text"])), " "), r"\s*-\s*", "-")
    score = F.aggregate("s", F.lit(0.0), lambda n, r: n + r["score"]) / F.size("s")
    ids = F.array_join(F.transform("s", lambda r: r["row_id"].cast("string")), ",")
    return both.select(*by, F.size("s").alias("n"), ids.alias("row_ids"), text.alias("text"), score.alias("score"))


def number_votes(rows: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Each cluster's number: most frames, then the largest sum of scores, then first seen."""
    counts = rows.groupBy(cluster, "text").agg(F.countDistinct("frame_index").alias("frames"), F.sum("score").alias("total"), F.avg("score").alias("confidence"), F.min("row_id").alias("first"))
    best = Window.partitionBy(cluster).orderBy(F.desc("frames"), F.desc(F.round("total", 9)), "first")
    return counts.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n", "first")


def visual_rows(slots: DataFrame, by: tuple = ("video",), height: float = 0.09) -> DataFrame:
    """Numbers the rows of slots: a new one where y jumps by more than ``height``."""
    order = Window.partitionBy(*by).orderBy("y", "x", "row_id")
    jump = F.coalesce(F.col("y") - F.lag("y").over(order) > height, F.lit(True))
    return slots.withColumn("__new", F.when(jump, 1).otherwise(0)).withColumn("row_index", F.sum("__new").over(order)).drop("__new")


def best_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the best score for each key; the first of equals."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "row_id")
    return rows.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")


def cluster_figures(rows: DataFrame, cluster: str = "cluster", by: tuple = ("video",)) -> DataFrame:
    """label_frames, frames, total and the median place of each cluster of detections.

    Frames are counted in two steps, so no row is multiplied for the distinct counts.
    """
    number = is_shirt_number(F.col("text_type"), F.col("text"))
    has = lambda c: F.max(F.when(c, 1).otherwise(0))
    frames = rows.groupBy(*by, cluster, "frame_index").agg(has(~number).alias("label"), has(number).alias("number"), F.sum(F.when(number, F.col("score"))).alias("total"))
    counts = frames.groupBy(*by, cluster).agg(F.sum("label").alias("label_frames"), F.sum("number").alias("frames"), F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"))
    places = rows.groupBy(*by, cluster).agg(F.median("x").alias("x"), F.median("y").alias("y"))
    return counts.join(places, [*by, cluster])


def top_clusters(clusters: DataFrame, k: int = 11, by: tuple = ("video",)) -> DataFrame:
    """The k clusters with a label, the most label frames, frames and score; in reading order."""
    rank = Window.partitionBy(*by).orderBy(F.desc(F.col("label_frames") > 0), F.desc("label_frames"), F.desc("frames"), F.desc(F.round("total", 9)), "cluster")
    chosen = clusters.withColumn("__n", F.row_number().over(rank)).filter(F.col("__n") <= k).drop("__n")
    return chosen.withColumn("slot", F.row_number().over(Window.partitionBy(*by).orderBy("y", "x", "cluster")))


def faults(rows: DataFrame) -> DataFrame:
    """Rows whose score or centres are null, not finite or outside 0 to 1."""
    good = F.lit(True)
    for c in ("score", "x", "y"):
        good = good & F.col(c).isNotNull() & F.col(c).between(0.0, 1.0)
    return rows.filter(~F.coalesce(good, F.lit(False)))
