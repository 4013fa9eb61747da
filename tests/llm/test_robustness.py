"""Nulls, empty tables, repeated rows, clashing columns and long texts, for every operator and stage."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanwright.llm import langid, licenses, mpeg, neardup, packing, quality, secrets, sharding
from spanwright.llm.decontam import contained_items, samples, shingle_rows
from spanwright.llm.queries import tokenizer_path

try:
    PATH = tokenizer_path()
except ImportError:
    PATH = ""
needs_tokenizer = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer file")
BASE = "doc_id long, text string, lang string, source string"
#: Names that the operators use themselves.
CLASHES = ["curve", "rank", "share", "spans", "base", "row", "token", "cell", "score", "license", "shingle", "part", "item_id", "feature", "id", "class_id", "n_shingles", "component_id", "kept", "found", "a.b", "__text", "__hash", "__cell", "__part", "text_hash", "lang_pred", "start", "size"]
R = random.Random(12)
WORDS = [f"w{i}" for i in range(300)]
PROSE = " ".join(R.choice(WORDS) for _ in range(120))
LONG = " ".join(R.choice(WORDS) for _ in range(150_000))


def _model(docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    return quality.learn(docs, labels)


OPERATORS = {
    "media": lambda d: mpeg.media_features(d),
    "secrets": lambda d: secrets.secret_spans(d),
    "neardup": lambda d: neardup.near_duplicates(d),
    "sharding": lambda d: sharding.hilbert_shards(d),
    "language": lambda d: langid.predict(d, *langid.learn(d)),
    "quality": lambda d: quality.quality_scores(d, _model(d)),
}
ROWS = [(1, PROSE, "en", "s"), (1, PROSE, "en", "s"), (2, None, None, None), (3, "", "en", ""), (4, " \n", "fr", "s"), (None, PROSE + " tail", "fr", "s"), (None, None, None, None), (5, LONG, "en", "s"), (6, "one", "de", "s")]


def rows(spark, n=None):
    frame = spark.createDataFrame(ROWS[:n], BASE)
    return frame.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, name):
    operator = OPERATORS[name]
    got = operator(rows(spark)).collect()
    key = lambda x: -1 if x is None else x
    assert sorted(key(x.doc_id) for x in got) == sorted(key(r[0]) for r in ROWS)
    plain = operator(spark.createDataFrame(ROWS, BASE)).collect()
    if name != "sharding":  # whose ties may stand either way
        assert sorted(map(str, got)) == sorted(map(str, plain))
        assert len({str(x) for x in got if x.doc_id == 1}) == 1
    assert operator(rows(spark, 0)).count() == 0


@needs_tokenizer
def test_packing_of_odd_rows(spark):
    frame = rows(spark)
    got = packing.packed(frame, PATH, packing.share_after_prompt(F.col("text"))).collect()
    assert sum(x.length for x in got if x.doc_id in (2, 3)) == 2 and sum(x.doc_id is None for x in got) == 2
    once, twice = (sorted((x.length, x.ids_crc32) for x in got if x.doc_id == i) for i in (6, 1))
    assert len(once) == 1 and len(twice) == 2 and twice[0] == twice[1]
    long = sorted((x.start, x.length) for x in got if x.doc_id == 5)
    assert sum(n for _, n in long) == next(x.doc_tokens for x in got if x.doc_id == 5) > 100_000
    assert packing.packed(rows(spark, 0), PATH).count() == 0


def test_licenses_of_odd_rows(spark):
    notice = licenses.TEMPLATES["gpl-3.0-header"]
    texts = [(1, notice), (1, notice), (2, None), (3, ""), (None, "Released under the MIT License."), (5, LONG + " " + notice + " " + LONG)]
    frame = spark.createDataFrame(texts, "doc_id long, text string").select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES) if c != "lang"))
    got = licenses.license_matches(frame).collect()
    best = sorted((str(x.doc_id), x.license) for x in got if x.best)
    assert best == [("1", "gpl-3.0-header"), ("5", "gpl-3.0-header"), ("None", "mit")]
    assert {x.license for x in got if x.doc_id == 1 and not x.best} >= {"gpl-header", "gpl-2.0-header"}
    with pytest.raises(ValueError):
        licenses.license_matches(frame, {"short": "four words are few"})


@pytest.mark.parametrize("name", ["agpl-3.0-header", "lgpl-2.1-header", "lgpl-3.0-header", "gpl-2.0-text", "apache-2.0-text", "apache-2.0-header", "unlicense-text", "cc0-1.0", "mit-whole-text", "mit-short"])
def test_the_right_license_of_a_family_is_best(spark, name):
    words = licenses.TEMPLATES[name].split()
    text = "a b c " + "\n * ".join(" ".join(words[i : i + 7]) for i in range(0, len(words), 7)) + " d e f"
    got = licenses.license_matches(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert name in {x.license for x in got if x.best and x.n_found == x.n_template}


def test_contained_items_of_odd_rows(spark):
    item = " ".join(WORDS[i * 7 % 300] for i in range(40))
    docs = spark.createDataFrame([(1, item), (1, "other words " * 9), (2, None), (None, item), (3, LONG + " " + item.upper())], "doc_id long, text string")
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))
    items = spark.createDataFrame([(1, item), (2, item), (2, item), (None, item), (3, None), (4, LONG)], "item_id long, text string").withColumn("doc_id", F.lit(7))
    got = sorted((x.doc_id, x.item_id) for x in contained_items(docs, items).collect())
    assert got == [(1, 1), (1, 2), (3, 1), (3, 2), (3, 4)]


def test_a_partition_of_large_items_samples_little(spark):
    docs = spark.createDataFrame([(1, LONG), (2, PROSE)], "doc_id long, text string")
    every = [x.shingle for x in shingle_rows(docs, "doc_id", "text").filter("doc_id = 1").collect()]
    low, high = sorted(every)[len(every) // 100], sorted(every)[len(every) // 2]
    got = {}
    for x in samples(docs, {4: high, 10: low}).filter("doc_id = 1").collect():
        got.setdefault(x.part, []).append(x.shingle)
    for part, threshold in ((4, high), (10, low)):
        assert sorted(got[part]) == sorted(s for s in every if s <= threshold)
    assert len(got[10]) < len(got[4]) / 40 and samples(docs, {}).count() == 0


@needs_tokenizer
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_any_columns(spark, tmp_path, name):
    spark.createDataFrame([(1, " ".join(WORDS[:30]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    frame = rows(spark).withColumn("n_chars", F.length("text").cast("long"))
    got = stage(spark, frame, str(tmp_path))
    if name == "packing":
        assert {x.doc_id for x in got.collect()} == {r[0] for r in ROWS}
    else:
        assert got.columns == frame.columns
        kept = sorted(str(x.doc_id) for x in got.collect())
        want = {"language": ["1", "1", "5", "6", "None"], "near_duplicates": ["1", "2", "3", "4", "5", "6", "None", "None"]}
        assert kept == want.get(name, sorted(str(r[0]) for r in ROWS))
    assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0
