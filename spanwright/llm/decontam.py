"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a small Jaccard with it, however
whole it is.  So the search asks for containment instead, with MinHash samples
of one hash function that are cut by a threshold, not by a count:

* The items are partitioned by size: those of 2**p to 2**(p+1)-1 shingles.  A
  partition's threshold is the least hash under which each of its items has
  ``q`` of its shingles (or all), so it falls as the items grow.
* An item's sketch is all its shingle hashes up to its partition's threshold,
  and a document's sample for a partition all of its own up to that; sketch
  and sample meet by partition and hash.  Whatever an item's sketch holds that
  the document has too is in the sample, however long the document is, and a
  partition of large items reads a small share of the documents' shingles.
* The share of an item's sketch found in a sample estimates its containment.
  Of a sketch of m values, as many must be found that an item of containment
  0.75 has fewer with a chance under ``MISS``, by Chernoff's bound; if the
  sketch is the whole item, just its share.  Exact containment over all the
  shingles of a candidate's document confirms it.

All of it is DataFrame operations: shingles are exploded and hashed within
one generated stage and filtered against the sketches at once, which are
broadcast where their counted rows are few; else the samples are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import checked_broadcast, cut, rows_of

Q, MISS, PERCENT, WIDTH = 16, 1e-6, 75, 5


def words_of(text: Column) -> Column:
    """Lower-cased words of a text between the six ASCII blanks; null: none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t-\r]+"), lambda w: w != "")


def shingle_rows(frame: DataFrame, key: str, text: str) -> DataFrame:
    """(key, shingle): the 64-bit hash of each run of five words, repeated or not.

    A text of one to four words has its whole sequence as one shingle.  Rows
    with a null key have none.
    """
    words = frame.filter(F.col(key).isNotNull()).select(F.col(key), words_of(F.col(text)).alias("w"))
    last = F.greatest(F.size("w") - WIDTH, F.least(F.size("w") - 1, F.lit(0)))
    # Nothing to explode without words: the sequence would run backwards.
    at = F.when(F.size("w") > 0, F.sequence(F.lit(0), last))
    word = [F.get("w", F.col("i") + j) for j in range(WIDTH)]
    return words.select(key, "w", F.explode(at).alias("i")).select(key, F.xxhash64(*word).alias("shingle"))


def least_found(m: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Of m values sampled from an item, the least number to ask for.

    The largest c such that fewer than c are found with a chance of at most
    ``miss`` if ``percent`` of the item is there; at least 1.  The bound of
    Chernoff and Hoeffding holds for samples without replacement.
    """
    p = percent / 100

    def chance(x: int) -> float:  # of x or fewer
        s = x / m
        apart = (s * math.log(s / p) if s else 0.0) + (1 - s) * math.log((1 - s) / (1 - p))
        return math.exp(-m * apart)

    c = 1
    while c < p * m and chance(c) <= miss:
        c += 1
    return c


def samples(documents: DataFrame, thresholds: dict[int, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, part, shingle): each document's shingles up to each partition's threshold."""
    parts = sorted(thresholds, key=lambda p: (-thresholds[p], p))
    rows = shingle_rows(documents, key, text)
    if not parts:
        return rows.select(key, F.lit(0).alias("part"), "shingle").filter(F.lit(False))
    # The partitions that admit a shingle come first in order of thresholds.
    admitted = sum((F.col("shingle") <= F.lit(thresholds[p])).cast("int") for p in parts)
    rows = rows.filter(F.col("shingle") <= F.lit(thresholds[parts[0]]))
    return rows.select(key, F.explode(F.slice(F.array(*map(F.lit, parts)), F.lit(1), admitted)).alias("part"), "shingle")


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    q: int = Q,
    percent: int = PERCENT,
    document_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_found, n_item) of each item that a document contains.

    An item is contained if ``percent`` of its distinct five-word shingles or
    more are in the document.  Texts that are null or blank contain nothing and
    are contained nowhere; null keys are ignored; rows that repeat a key are
    one document or item with all their shingles, and equal items are found
    each.  Either table may be empty; other columns are ignored.
    """
    docs = documents.select(F.col(f"`{document_key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    item = cut(
        shingle_rows(items.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{text}`").alias("text")), "item_id", "text").distinct()
    )
    # An item's shingles in one row: an item is one text, so this is bounded by it.
    sizes = item.groupBy("item_id").agg(F.count("*").cast("int").alias("n_item"), F.sort_array(F.collect_set("shingle")).alias("all"))
    sizes = cut(sizes.withColumn("part", F.floor(F.log2(F.col("n_item").cast("double"))).cast("int")))
    last = F.element_at("all", F.least(F.col("n_item"), F.lit(q)))
    # One row for each power of two: 31 at most.
    thresholds = {part: threshold for part, threshold in sizes.groupBy("part").agg(F.max(last)).collect()}
    of_part = F.element_at(F.create_map(*(F.lit(x) for kv in (thresholds or {0: 0}).items() for x in kv)), F.col("part"))
    sketches = sizes.select("item_id", "n_item", "part", F.filter("all", lambda h: h <= of_part).alias("sketch"))
    sketches = cut(sketches.select("item_id", "n_item", "part", F.size("sketch").alias("m"), F.explode("sketch").alias("shingle")))
    found = (
        samples(docs, thresholds)
        .join(checked_broadcast(sketches), ["part", "shingle"])
        .groupBy("doc_id", "item_id", "n_item", "m", "shingle")
        .count()
        .groupBy("doc_id", "item_id", "n_item", "m")
        .agg(F.count("*").alias("n_sketch"))
    )
    most = sketches.agg(F.max("m")).first()[0] or 1
    bounds = F.array(*(F.lit(least_found(m, percent)) for m in range(1, most + 1)))
    # A sketch that is the whole item estimates exactly.
    asked = F.when(F.col("m") == F.col("n_item"), F.ceil(F.col("n_item") * percent / 100)).otherwise(F.element_at(bounds, F.col("m")))
    candidates = cut(found.filter(F.col("n_sketch") >= asked).select("doc_id", "item_id", F.col("n_item").cast("long").alias("n_item")))

    held = rows_of(docs, candidates.select("doc_id").distinct(), "doc_id")
    wanted = candidates.join(item, "item_id")
    confirmed = (
        shingle_rows(held, "doc_id", "text")
        .join(checked_broadcast(item.select("shingle").distinct()), "shingle", "left_semi")
        .distinct()
        .join(wanted, ["doc_id", "shingle"])
        .groupBy("doc_id", "item_id", "n_item")
        .agg(F.count("*").alias("n_found"))
    )
    return confirmed.filter(F.col("n_found") * 100 >= F.col("n_item") * percent).select("doc_id", "item_id", "n_found", "n_item")


def decontaminated(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with all their columns.

    Rows that repeat a key go or stay together; null keys, null and blank texts
    stay; columns may have any names.
    """
    names, inner = documents.columns, [f"c{i}" for i in range(len(documents.columns))]
    key = inner[names.index(options.get("document_key", "doc_id"))]
    dirty = cut(contained_items(documents, items, **options).select(F.col("doc_id").alias(key)).distinct())
    return documents.toDF(*inner).join(checked_broadcast(dirty), key, "left_anti").select(*inner).toDF(*names)


#: DuckDB SQL of contained_items(documents, benchmark), by brute force.
CONTAINED_ITEMS = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') FROM benchmark),
n AS (SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w WHERE id IS NOT NULL),
s AS (SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s FROM n),
sizes AS (SELECT id AS item_id, count(*) AS n_item FROM s WHERE side = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_found, n_item
FROM s d JOIN s i ON d.s = i.s AND d.side = 'd' AND i.side = 'i' JOIN sizes ON sizes.item_id = i.id
GROUP BY d.id, i.id, n_item HAVING count(*) * 100 >= n_item * 75
"""
