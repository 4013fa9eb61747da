"""Accuracy on rows that were held out, and what an order along the curve prunes, on the shared tables."""

import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from spanwright.llm import queries, sharding

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables")


def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = queries.QUERIES["op8_language"](spark, DATA).collect()
    assert len(got) == len(truth)
    for x in got:
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) and 0 <= x.score <= 1
    held = [x for x in got if x.held_out and truth[x.doc_id][0] and x.lang_pred != "und"]
    assert len(held) > 100 and sum(x.lang_pred == truth[x.doc_id][0] for x in held) / len(held) >= 0.98


def test_quality_of_held_out_documents(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = {x.doc_id: x for x in queries.QUERIES["op9_quality"](spark, DATA).collect()}
    held = [i for i in truth if i in got and got[i].held_out]
    right = [got[i].predicted == truth[i] for i in held]
    assert len(held) > 20 and sum(right) / len(right) >= 0.97
    good, bad = ([got[i].score for i in held if truth[i] == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.99


def test_runs_of_the_curve_prune_more_than_one_column(spark):
    """Shards that boxes over size and key touch, against an order by either column."""
    r = random.Random(3)
    frame = spark.createDataFrame([(i, "x" * r.randrange(5000)) for i in range(8000)], "doc_id long, text string")
    placed = sharding.hilbert_shards(frame, shards=64)
    zones = [(z.min_size, z.max_size, z.min_doc_id, z.max_doc_id) for z in sharding.zone_maps(placed, ["size", "doc_id"]).collect()]
    by_column = {}
    for c in ("size", "doc_id"):
        order = sorted(((len(x.text) + 1 if c == "size" else x.doc_id, len(x.text) + 1, x.doc_id) for x in frame.collect()))
        runs = [order[i : i + 125] for i in range(0, len(order), 125)]
        by_column[c] = [(min(s for _, s, _ in run), max(s for _, s, _ in run), min(k for _, _, k in run), max(k for _, _, k in run)) for run in runs]
    boxes = []
    for _ in range(200):
        a, b = r.randrange(4000), r.randrange(6400)
        boxes.append((a, a + 1000, b, b + 1600) if r.random() < 0.5 else r.choice([(a, a + 500, 0, 8000), (0, 5001, b, b + 800)]))
    touched = lambda shards: sum(z[0] <= q[1] and q[0] <= z[1] and z[2] <= q[3] and q[2] <= z[3] for q in boxes for z in shards)
    curve, size, key = touched(zones), touched(by_column["size"]), touched(by_column["doc_id"])
    assert curve < 0.75 * min(size, key), (curve, size, key)


def test_shards_equal_a_plain_sort(spark):
    got = queries.QUERIES["op6_sharding"](spark, DATA).collect()
    order = sorted(got, key=lambda x: (x.curve, x.doc_id, x.text_crc32, x.size))
    n = len(order)
    for rank, x in enumerate(order):
        shard = rank * 16 // n
        assert (x.shard, x.slot) == (shard, rank - -(-shard * n // 16)), rank
    texts = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.octet_length("text").alias("n"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")).collect()}
    assert all((x.size, x.text_crc32) == ((texts[x.doc_id].n or 0) + 1, texts[x.doc_id].crc) for x in got)
