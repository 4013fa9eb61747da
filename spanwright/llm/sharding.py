"""Hilbert-curve ordering of rows into shards.

Several metadata dimensions are quantised to ``bits`` bits each: numbers by the
quantiles of the whole table, words by a hash of their own that keeps equal
values together.  The cells are numbered along a Hilbert curve, rows are
sorted by that number, and the order is cut into runs of equal counts.  A run
is a compact region in all dimensions at once, so minima and maxima of a
shard's columns prune files for filters on any of them.

The global rank needs no global sort in one task: rows are range partitioned
by the curve's index and a tie-breaker, the partition numbers are written with
the rows, and each partition ranks its rows above the counts of those before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.llm.common import cut

SHARDS, BITS = 16, 10


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points, an (n, dims) array below 2**bits.

    Skilling's transform, on all points at once; dims * bits is at most 63.
    """
    x = [points[:, i].astype(np.uint64) for i in range(points.shape[1])]
    dims = len(x)
    one = np.uint64(1)
    top = one << np.uint64(bits - 1)
    q = top
    while q > one:
        p = q - one
        for i in range(dims):
            here = (x[i] & q) != 0
            swapped = (x[0] ^ x[i]) & p
            x[0] = np.where(here, x[0] ^ p, x[0] ^ swapped)
            if i:
                x[i] = np.where(here, x[i], x[i] ^ swapped)
        q >>= one
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > one:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    for i in range(dims):
        x[i] ^= t
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << one) | ((x[i] >> np.uint64(bit)) & one)
    return index.astype(np.int64)


def _quantised(frame: DataFrame, numbers: list[str], words: list[str], bits: int) -> Column:
    """array<int> of each row's cell; null is the lowest cell."""
    steps = min(1 << bits, 256)
    shares = [i / steps for i in range(1, steps)]
    bounds = frame.agg(*(F.percentile_approx(c, shares, 10_000).alias(c) for c in numbers)).first() if numbers else {}
    cells = []
    for c in numbers:
        edges = sorted(set(bounds[c] or []))
        # Cells of equal shares, spread over the whole range of the curve.
        cell = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(c))) if edges else F.lit(0)
        cells.append((F.coalesce(F.when(F.col(c).isNotNull(), cell), F.lit(0)) * ((1 << bits) // steps)).cast("int"))
    for c in words:
        cells.append(F.coalesce(F.pmod(F.xxhash64(F.col(c)), F.lit(1 << bits)), F.lit(0)).cast("int"))
    return F.array(*cells)


def hilbert_order(frame: DataFrame, numbers: list[str], words: list[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """The frame with the rows' index on the curve in column ``name``."""
    fields = frame.withColumn("__cell", _quantised(frame, numbers, words, bits))
    dims = len(numbers) + len(words)
    kept = frame.columns

    def indexed(batches):
        for batch in batches:
            cells = batch.column(len(kept)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(hilbert_index(cells, bits))], names=[*kept, name])

    schema = frame.withColumn(name, F.lit(0).cast("long")).schema
    return fields.mapInArrow(indexed, schema)


def ranked(frame: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """The frame with each row's global rank (from 0) in an order.

    Rows that are equal in all of ``order`` get neighbouring ranks in either
    way.  The frame is cut once; only counts of partitions meet in one task,
    as many as there are partitions.
    """
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(frame.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (
        placed.withColumn("__within", within)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.col("__within") - 1)
        .drop("__part", "__within", "__before")
    )


def hilbert_shards(documents: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve of each row.

    The dimensions are the text's size, the key, the language and the source.
    The law is ``rows``: shards take runs of the order whose counts differ by
    one at most, and ``slot`` counts from 0 within each.  ``size`` is the
    text's UTF-8 bytes plus 1, a null text having none, and ``text_crc32`` that
    of an empty text.  Nulls in any dimension lie in its lowest cell; rows that
    repeat a key are placed each by itself; an empty table gives no rows.
    """
    has = {c: F.col(f"`{c}`") if c in documents.columns else F.lit(None) for c in ("lang", "source")}
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = cut(
        documents.select(
            F.col(f"`{key}`").cast("long").alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            *(c.cast("string").alias(n) for n, c in has.items()),
        )
    )
    placed = ranked(hilbert_order(rows, ["size", "doc_id"], ["lang", "source"]), ["curve", "doc_id", "text_crc32", "size"])
    total = rows.count()
    # Shard s holds ranks from ceil(s * total / shards) on.
    shard = F.expr(f"rank * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def zone_maps(placed: DataFrame, columns: list[str], shard: str = "shard") -> DataFrame:
    """Rows, minima and maxima of each shard, for pruning files."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy(shard).agg(F.count("*").alias("n_rows"), *bounds)
