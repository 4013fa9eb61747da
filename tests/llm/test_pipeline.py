import pytest

import corpus_pipeline


def test_stages_on_a_fixture(spark, tmp_path):
    prose = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i % 7)} text" for i in range(60))
    other = " ".join(f"mot{chr(97 + i % 26)}{chr(98 + i % 5)} phrase" for i in range(60))
    item = "question about the exact order of things that must never be seen in training"
    rows = [
        (1, prose, "en", "s"), (2, prose + " tail", "en", "s"), (2, prose + " tail", "en", "s"), (3, other, "fr", "s"), (4, "123 456", "en", "s"), (5, None, None, None),
        (6, other[::-1] + " " + item, "fr", "s"), (7, "mail me at a.b@mail.example.com " + prose[::-1], "en", None), (8, prose[200:] + " zebra" * 30, "en", "s"),
    ]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, names = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == names, name
    found = {r.doc_id: r for r in kept.collect()}
    assert sorted(found) == [1, 3, 7, 8]
    assert "mail.example.com" not in found[7].text and found[7].n_chars == len(found[7].text)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {1, 3, 7, 8}


def test_a_key_of_two_texts_loses_only_the_copy(spark, tmp_path):
    from spanwright.llm import stages

    copied, alone = (" ".join(f"{n}{i * i % 97} {n}{i}" for i in range(60)) for n in ("copy", "alone"))
    rows = [(5, copied), (7, alone), (7, copied + " tail"), (7, alone), (8, copied), (9, alone + " end"), (3, "two"), (3, "texts"), (None, alone)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    kept = stages.near_duplicate(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((x.doc_id or 0, x.text) for x in kept.collect()) == sorted([(5, copied), (7, alone), (3, "two"), (3, "texts"), (0, alone)])


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names(name):
    assert name
