"""Data sets of labelled frames: splits, sampling, integrity."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def drawn_split(ids: list[str], val: float = 0.15, test: float = 0.15, seed: int = 42, val_ids: tuple = (), test_ids: tuple = ()) -> dict[str, str]:
    """Split of each id: explicit ids, or a seeded draw of a share, at least one.

    ``ids`` are keys of series, few enough for the driver; the rows are not.
    """
    ids = sorted(set(ids))
    unknown = (set(val_ids) | set(test_ids)) - set(ids)
    if unknown or set(val_ids) & set(test_ids):
        raise ValueError(f"unknown or repeated ids: {sorted(unknown | set(val_ids) & set(test_ids))}")
    rest = [i for i in ids if i not in val_ids and i not in test_ids]
    random.Random(seed).shuffle(rest)
    held = {"test": list(test_ids), "val": list(val_ids)}
    for name, share in (("test", test), ("val", val)):
        if not held[name] and share > 0:
            n = max(1, round(len(ids) * share))
            held[name], rest = rest[:n], rest[n:]
    out = {i: "train" for i in ids} | {i: n for n in ("val", "test") for i in held[n]}
    if "train" not in out.values():
        raise ValueError("no id is left for training")
    return out


def hashed_split(frames: DataFrame, val: float = 0.15, test: float = 0.15, seed: int = 42, key: str = "video") -> DataFrame:
    """(key, split) by the order of a hash of key and seed, without the driver.

    The hash's leading digits are counted first, so each id is ranked among
    those of its cell alone, above the counts of the cells before.
    """
    token = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    ids = frames.select(key).distinct().withColumn("__token", token).withColumn("__cell", F.substring("__token", 1, 3))
    # 4096 cells at most: a bounded broadcast.
    cells = ids.groupBy("__cell").agg(F.count("*").alias("__n"))
    upto, n = F.sum("__n").over(Window.orderBy("__cell")), F.sum("__n").over(Window.partitionBy())
    cells = cells.select("__cell", (upto - F.col("__n")).alias("__before"), n.alias("__all"))
    size = lambda share: F.greatest(F.lit(1), F.bround(F.col("__all") * share).cast("long"))
    place = F.col("__before") + F.row_number().over(Window.partitionBy("__cell").orderBy("__token", key))
    split = F.when(place <= size(test), "test").when(place <= size(test) + size(val), "val").otherwise("train")
    return ids.join(F.broadcast(cells), "__cell").select(key, split.alias("split"))


def with_split(frames: DataFrame, splits: dict[str, str], key: str = "video") -> DataFrame:
    """The rows with the split of their key, from a map such as drawn_split() gives."""
    rows = frames.sparkSession.createDataFrame(list(splits.items()), "__key string, split string")
    held = F.broadcast(rows) if len(splits) <= 100_000 else rows
    return frames.join(held, F.col(key).cast("string") == F.col("__key"), "left").drop("__key")


def split_leaks(rows: DataFrame, key: str = "video") -> DataFrame:
    """Keys with rows in more than one split."""
    return rows.groupBy(key).agg(F.countDistinct("split").alias("splits")).filter("splits > 1")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, and how many more."""
    return rows.groupBy(*keys).agg((F.count("*") - 1).alias("extra")).filter("extra > 0")


def downsampled(frames: DataFrame, per_positive: int = 5, seed: int = 42, key: tuple = ("video", "t"), label: str = "label") -> DataFrame:
    """All positives and the first negatives, by a hash, of a fixed number for each.

    The number is exact.  The cut is found in two steps, so no task ranks all
    negatives: first the hash's leading digits are counted, then only the
    negatives in the cell of the cut are ranked.
    """
    token = F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in key), F.lit(str(seed))))
    rows = frames.withColumn("__token", token)
    wanted = frames.filter(F.col(label) == 1).count() * per_positive
    negatives = rows.filter(F.col(label) != 1)
    cells = negatives.groupBy(F.substring("__token", 1, 3).alias("__cell")).agg(F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.orderBy("__cell"))
    cells = cells.withColumn("__upto", upto).withColumn("__left", F.lit(wanted) - (F.col("__upto") - F.col("__n"))).filter("__left > 0")
    # 4096 cells at most: a bounded broadcast.
    placed = negatives.withColumn("__cell", F.substring("__token", 1, 3)).join(F.broadcast(cells), "__cell")
    whole = placed.filter("__left >= __n")
    edge = placed.filter("__left < __n").withColumn("__rank", F.row_number().over(Window.partitionBy("__cell").orderBy("__token"))).filter("__rank <= __left")
    return rows.filter(F.col(label) == 1).select(frames.columns).unionByName(whole.select(frames.columns)).unionByName(edge.select(frames.columns))


def summary(rows: DataFrame, by: list[str], key: str = "video", label: str = "label") -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(label).cast("long").alias("n_positive"), F.countDistinct(key).alias("n_keys"))


def not_in(rows: DataFrame, known: DataFrame, key: str = "video") -> DataFrame:
    """Keys of ``rows`` that ``known`` lacks."""
    return rows.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")


def only_in(rows: DataFrame, known: DataFrame, key: str = "video") -> DataFrame:
    return rows.join(known.select(key).distinct(), key, "left_semi")
