"""Steps without SQL against plain second implementations, over table rows and random ones."""

import os
import random
from collections import defaultdict

import pytest

from spanwright.functions.text import NUMBER, alike, plain
from spanwright.operators import resolve as rs
from spanwright.plans import registry, views

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables")


def blocks(a, b):
    """Letters in matching blocks: the longest common run, the first of equals, then both sides of it."""
    best = (0, 0, 0)
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n > best[0]:
                best = (n, i, j)
    n, i, j = best
    return n and n + blocks(a[:i], b[:j]) + blocks(a[i + n :], b[j + n :])


def ratio(a, b):
    return 2 * blocks(a, b) / (len(a) + len(b)) if a and b else 0.0


def test_similarity_of_random_texts():
    r = random.Random(1)
    for _ in range(1500):
        a, b = ("".join(r.choice("abc de") for _ in range(r.randint(0, 14))) for _ in range(2))
        assert alike(a, b) == pytest.approx(ratio(a, b))


@needs_data
def test_similarity_of_a_table(spark):
    rows = {r.p_partkey: (r.p_name, r.p_type) for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    for x in registry.QUERIES["text_similarity"](spark, DATA).collect():
        assert x.similarity == pytest.approx(ratio(*map(plain, rows[x.p_partkey])))


def plain_consensus(votes, least=0.84):
    groups = []
    for v in votes:
        for g in groups:
            if ratio(plain(v[0]), plain(g[0][0])) >= least:
                g.append(v)
                break
        else:
            groups.append([v])
    if not groups:
        return "", 0.0, 0

    def best(parts):
        chosen = None
        for p in parts:
            rank = (len({v[2] for v in p}), sum(v[1] for v in p))
            if chosen is None or rank > chosen[0]:
                chosen = (rank, p)
        return chosen[1]

    group = best(groups)
    spellings = defaultdict(list)
    for v in group:
        spellings[plain(v[0])].append(v)
    spelling = best(spellings.values())
    return spelling[0][0], sum(v[1] for v in spelling) / len(spelling), len({v[2] for v in group})


def near_signature(left, right):
    used, hits = [], 0
    for a in left:
        open_ = [(abs(a.x - b.x) + abs(a.y - b.y), i) for i, b in enumerate(right) if i not in used and a.text == b.text and abs(a.x - b.x) <= 0.045 and abs(a.y - b.y) <= 0.065]
        if open_:
            used.append(sorted(open_)[0][1])
            hits += 1
    return hits / min(len(left), len(right)) if left and right else 0.0


def plain_events(rows, options):
    frames = defaultdict(list)
    for r in rows:
        if r.kind == NUMBER and r.text.isdigit() and 1 <= int(r.text) <= 99:
            frames[r.frame].append(r)
    out = []
    for frame in sorted(frames):
        shot = frames[frame]
        if len(shot) >= options.least_numbers:
            last = out[-1] if out else []
            joins = last and shot[0].time - max(s[0].time for s in last) <= options.same_gap and any(near_signature(shot, s) >= options.same_signature for s in last)
            last.append(shot) if joins else out.append([shot])
    return [(min(s[0].time for s in e), max(s[0].time for s in e), len(e)) for e in out]


@needs_data
def test_consensus_and_events_of_all_segments(spark):
    segments = defaultdict(list)
    for r in registry._segments(spark, DATA).collect():
        row = rs.Row(r.row_id, r.frame_index, r.timestamp_seconds, r.text, r.text_type, r.score, r.x, r.y, norm=plain(r.text))
        segments[r.video, r.segment_index].append(row)
    events, texts = defaultdict(list), {}
    for x in registry.QUERIES["events_by_gap_signature"](spark, DATA).orderBy("event").collect():
        events[x.video, x.segment_index].append((x.start_seconds, x.end_seconds, x.n))
    for x in registry.QUERIES["fuzzy_consensus"](spark, DATA).collect():
        texts[x.video, x.segment_index] = (x.text, x.confidence, x.frames)
    assert len(segments) > 20 and sum(map(len, events.values())) > 20
    for key, rows in segments.items():
        rows.sort(key=lambda r: r.row_id)
        assert events.get(key, []) == plain_events(rows, registry._OPTIONS)
        want = plain_consensus([(r.text, r.score, r.frame) for r in rows if r.kind != NUMBER])
        assert texts[key][0] == want[0] and texts[key][1] == pytest.approx(want[1]) and texts[key][2] == want[2]


@needs_data
def test_lineups_have_every_outcome(spark):
    found = {(x.status, x.resolution_method) for x in registry.QUERIES["lineup_diagnostics"](spark, DATA).collect()}
    assert found == {("resolved", "table"), ("resolved", "formation"), ("unresolved", "")}
    assert views.lineups(spark, DATA).count() > 0
