import hashlib
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanwright.llm import langid, mpeg, quality, sharding
from spanwright.llm.packing import Packer, WordTokenizer, conversation_examples, packed, share_after_prompt

KIND = "doc_id long, text string"


def test_streams_round_trip_and_resynchronise():
    r = random.Random(1)
    for n in (192, 384, 960, 192 * 40):
        payload = r.randbytes(n)
        data = mpeg.write_stream(payload)
        stream = mpeg.read_stream(data)
        assert mpeg.stored_payload(stream) == payload and stream["bad"] == 0 and stream["skipped"] == 0
        assert stream["samples"] == 1152 * len(stream["offsets"]) and stream["table"]["frames"] == len(stream["offsets"])
    at = stream["offsets"][3]
    broken = mpeg.read_stream(data[:at] + b"\xff\xfa junk \xff" + data[at:])
    assert mpeg.stored_payload(broken) == payload and broken["skipped"] > 0
    flipped = bytearray(data)
    flipped[at + 10] ^= 1
    assert mpeg.read_stream(bytes(flipped))["bad"] == 1
    tagged = mpeg.read_stream(data + b"TAG" + b"Title".ljust(125, b"\x00"))
    assert tagged["tags"]["TIT2"] == "Title" and tagged["skipped"] == 0
    for _ in range(200):
        mpeg.read_stream(r.randbytes(r.randint(0, 200)))
    assert mpeg.read_stream(b"")["offsets"] == []


def test_media_rows(spark):
    texts = [None, "", "é" * 96, "x" * 5000, "x" * 5000]
    rows = {x.doc_id: x for x in mpeg.media_features(spark.createDataFrame(list(enumerate(texts)), KIND)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        x = rows[i]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert x.duration_us == 24000 * x.n_frames == 24000 * len(x.frame_offsets)
    assert rows[3].media_sha256 == rows[4].media_sha256


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_each_cell_and_steps_by_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1).max() == 1


def test_shards_are_even_gapless_and_prune(spark):
    r = random.Random(2)
    rows = [(i, "x" * r.randrange(3000), r.choice("ab"), f"s{r.randrange(20)}") for i in range(1003)] + [(None, None, None, None), (5, "x", "a", "s1"), (5, "x", "a", "s1")]
    frame = spark.createDataFrame(rows, KIND + ", lang string, source string")
    shards = sharding.hilbert_shards(frame)
    placed = shards.collect()
    counts = {}
    for x in placed:
        counts.setdefault(x.shard, []).append(x.slot)
    assert sorted(counts) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    zones = sharding.zone_maps(shards, ["size", "doc_id"]).collect()
    assert sum(z.min_size <= 500 <= z.max_size and z.min_doc_id <= 500 <= z.max_doc_id for z in zones) <= 8
    few = sharding.hilbert_shards(frame.limit(3)).collect()
    assert len(few) == 3 and sharding.hilbert_shards(frame.limit(0)).count() == 0


def test_mixtures():
    r = random.Random(3)
    words = {"aa": ["abba", "baab", "abab"], "bb": ["cddc", "dccd", "ecde"]}
    model = np.full((langid.GRAMS, 2), 0.5)
    for i, pool in enumerate(words.values()):
        model[:, i] += langid.gram_counts(" ".join(r.choice(pool) for _ in range(4000)))
    model /= model.sum(axis=0)
    pure = langid.gram_counts(" ".join(r.choice(words["aa"]) for _ in range(200)))
    assert langid.infer(pure, model).tolist() == [1.0, 0.0]
    mixed = langid.gram_counts(" ".join([r.choice(words["aa"]) for _ in range(300)] + [r.choice(words["bb"]) for _ in range(100)]))
    assert langid.infer(mixed, model) == pytest.approx([0.75, 0.25], abs=0.05)
    share, first = langid.mixture(mixed[mixed > 0].astype(float), model[mixed > 0], np.array([0.5, 0.5]), 1)
    assert langid.mixture(mixed[mixed > 0].astype(float), model[mixed > 0], share, 5)[1] >= first
    assert langid.gram_counts("12 :;") is None and langid.gram_counts(None) is None


def test_languages_of_rows(spark):
    rows = [(i, "abba baab " * 9 if i % 2 else "cddc dccd " * 9, "aa" if i % 2 else "bb") for i in range(60)] + [(100, None, "aa"), (101, "123", "aa"), (102, "abba", None)]
    frame = spark.createDataFrame(rows, KIND + ", lang string")
    names, model = langid.learn(frame)
    got = {x.doc_id: x for x in langid.predict(frame, names, model).collect()}
    assert names == ["aa", "bb"] and all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[102].lang_pred == "aa"
    assert sorted(set(range(100, 103)) - {x.doc_id for x in langid.accepted(frame).collect()}) == [100, 101]
    empty = langid.learn(frame.limit(0))
    assert {x.lang_pred for x in langid.predict(frame, *empty).collect()} == {"und"}


def test_rules_in_spark_equal_the_model(spark):
    r = random.Random(4)
    texts = [" ".join(f"word{r.randrange(300)}" + ("%%%" if i % 3 == 0 else "") for _ in range(r.randint(1, 80))) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000, None), (1001, "")], KIND)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(600)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = {x.doc_id: x for x in quality.quality_scores(docs, model).collect()}
    values = np.array([quality.statistics(t) for t in texts])
    assert np.allclose(model.apply(values), [got[i].score for i in range(600)], atol=1e-9)
    assert np.mean([got[i].predicted == int(i % 3 != 0) for i in range(600)]) > 0.97
    assert 0 <= got[1000].score == got[1001].score <= 1
    assert quality.fit(np.empty((0, 14)), np.empty(0, int)).apply(np.zeros((1, 14)))[0] == 0.5


PATH = None
try:
    import public_tokenizers

    PATH = public_tokenizers.path("word_bpe_49k.json")
except ImportError:
    pass
needs_tokenizer = pytest.mark.skipif(PATH is None or not os.path.exists(PATH), reason="no tokenizer file")


@needs_tokenizer
def test_ids_equal_the_library():
    tokenizer = WordTokenizer(PATH, most=50)
    r = random.Random(5)
    letters = "aAbBéÉ'sİıßſΣσς<|startoftext|>01²½ \t\x85\xa0​你😀ﬁ\x1c\nLLll,."
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        assert tokenizer.ids(text).tolist() == tokenizer.whole.encode(text, add_special_tokens=False).ids


def test_packer_keeps_all_limits():
    r = random.Random(6)
    packer = Packer(100, 6, 60)
    sizes = [r.choice((1, 5, 30, 99, 100, 250)) for _ in range(500)]
    pieces = list(packer.add([(i, n, r.random()) for i, n in enumerate(sizes)], flush=True))
    seen, room = {}, {}
    for example, start, length, sequence, offset in pieces:
        seen.setdefault(example, []).append((start, length))
        room.setdefault(sequence, []).append((offset, length))
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100 and len(parts) <= 6
    with pytest.raises(ValueError):
        list(Packer(10, 5, 10, cut=False).add([(0, 11, 1.0)], flush=True))


def plain_packing(examples, limits):
    """Dot-product packing of a few examples at once, straight from its rule."""
    length, out, sequence, top = limits[0], [], -1, -1
    waiting = []
    for name, tokens, share in examples:
        at = 0
        while tokens - at >= length and share <= limits[2] / length:
            top += 1
            out.append((name, at, length, top, 0))
            at += length
        if tokens > at:
            waiting.append([name, at, tokens - at, int(round((tokens - at) * share))])
    room = (0, 0, 0)
    while waiting:
        if sequence < 0 or not room[0] or not room[1]:
            top += 1
            sequence, room = top, limits
        fits = [w for w in waiting if w[2] <= room[0] and 1 <= room[1] and w[3] <= room[2]]
        if fits:
            x, y, z = (r / m / m for r, m in zip(room, limits))
            dot = lambda w: w[2] * x + y + w[3] * z
            best = max(dot(w) for w in fits)
            chosen = next(w for w in fits if dot(w) == best)
            part, loss = chosen[2], chosen[3]
        else:
            chosen = next(w for w in waiting if w[2] == max(x[2] for x in waiting))
            part = min(room[0], chosen[2])
            part = min(part, room[2] * chosen[2] // chosen[3]) if chosen[3] else part
            loss = min(chosen[3], room[2], -(-chosen[3] * part // chosen[2]))
            if part <= 0:
                room = (0, 0, 0)
                continue
        out.append((chosen[0], chosen[1], part, sequence, length - room[0]))
        room = (room[0] - part, room[1] - 1, room[2] - loss)
        chosen[1:] = [chosen[1] + part, chosen[2] - part, chosen[3] - loss]
        waiting = [w for w in waiting if w[2]]
    return out


def test_packer_chooses_as_its_rule_says():
    r = random.Random(7)
    for _ in range(300):
        limits = (r.choice((64, 128)), r.choice((3, 6)), r.choice((40, 64)))
        examples = [(i, r.randint(1, 150), r.choice((0.0, 0.5, 0.9, 1.0, r.random()))) for i in range(r.randint(0, 40))]
        assert list(Packer(*limits).add(examples, flush=True)) == plain_packing(examples, limits)


def test_registered_limits_bind_with_little_padding():
    r = random.Random(8)
    examples = [(i, r.choice((r.randint(5, 120), r.randint(200, 1200), r.randint(1200, 9000))), r.choice((0.5, 0.9, 0.98, 1.0))) for i in range(3000)]
    packer, out = Packer(), []
    for i in range(0, len(examples), 256):
        out += packer.add(examples[i : i + 256])
    out += packer.add([], flush=True)
    shares, counts, loss, tokens = {i: s for i, _, s in examples}, {}, {}, {}
    for example, _, length, sequence, _ in out:
        counts[sequence] = counts.get(sequence, 0) + 1
        loss[sequence] = loss.get(sequence, 0) + length * shares[example]
        tokens[sequence] = tokens.get(sequence, 0) + length
    assert max(counts.values()) == 16 and max(tokens.values()) == 4096 and 3950 < max(loss.values()) <= 3968 + 16
    assert sum(tokens.values()) / (4096 * len(tokens)) > 0.97


@needs_tokenizer
def test_packed_rows(spark):
    rows = [(i, "some words here " * (i % 50) ** 2) for i in range(200)] + [(None, None), (3, ""), (3, "again")]
    tokenizer = WordTokenizer(PATH)
    got = packed(spark.createDataFrame(rows, KIND).coalesce(2), PATH).collect()
    for i in range(4, 200):
        ids = np.append(tokenizer.ids(rows[i][1]), np.uint32(2)).astype("<u4")
        parts = sorted((x.start, x.length, x.ids_crc32) for x in got if x.doc_id == i)
        assert sum(p[1] for p in parts) == len(ids) and all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in parts)
    total = sum(x.length for x in got)
    assert total / (4096 * len({x.sequence_id for x in got})) > 0.95
    talk = spark.createDataFrame([(1, 2, "assistant", "yes"), (1, 1, "user", "really?"), (2, 1, None, None)], "conv_id long, turn long, role string, text string")
    examples = {x.doc_id: x for x in conversation_examples(talk).collect()}
    shares = [x[0] for x in spark.createDataFrame([(None,), ("",), ("one line",), ("a\nbcd",), ("\nx",)], "t string").select(share_after_prompt(F.col("t"))).collect()]
    assert shares == [0, 0, 1, pytest.approx(0.8), 1]
    assert examples[1].text == "really?\nyes" and examples[1].loss_share == pytest.approx(4 / 12) and examples[2].loss_share == 0
