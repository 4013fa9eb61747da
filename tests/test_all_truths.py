import datetime
import itertools
import os
import random

import pytest

from spanwright.plans import registry

DATA = "/root/testdata/sf0.001"


def iou(a, b):
    both = max(0.0, min(a[1], b[1]) - max(a[0], b[0]))
    return both / (a[1] - a[0] + b[1] - b[0] - both)


def best_by_brute_force(truths, predictions):
    """(sum of IoU, pairs) of the best of all ordered matchings."""
    best = (0.0, 0)
    for n in range(1, min(len(truths), len(predictions)) + 1):
        for left in itertools.combinations(truths, n):
            for right in itertools.combinations(predictions, n):
                values = [iou(a, b) for a, b in zip(left, right)]
                if all(values):
                    best = max(best, (round(sum(values), 12), n))
    return best


def runs_of(events):
    """[start, end) of each run of purchases and views of one series, in seconds."""
    out, since = [], None
    for t, kind in events:
        if kind in ("purchase", "view"):
            since = t if since is None else since
        elif since is not None:
            out.append((since, t))
            since = None
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d, r = str(tmp_path_factory.mktemp("events")), random.Random(11)
    epoch, rows, truths = datetime.datetime(2024, 1, 1), [], {}
    for user in range(1, 5):
        events, hot, scored = [], False, False
        for i in range(60):
            # Truths and scores change about every third and fourth event.
            hot, scored = hot != (r.random() < 0.25), scored != (r.random() < 0.2)
            events.append((i * 21_600.0, "purchase" if hot and i < 59 else "click", 90.0 if scored else 5.0))
        truths[user] = runs_of([e[:2] for e in events])
        rows += [(user * 1000 + i, epoch + datetime.timedelta(seconds=t), user, kind, value) for i, (t, kind, value) in enumerate(events)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{d}/events.parquet")
    predictions = {}
    for p in registry.QUERIES["flagship_segments"](spark, d).collect():
        predictions.setdefault(p.video, []).append((p.start_seconds, p.end_seconds))
    return d, rows, truths, {user: sorted(found) for user, found in predictions.items()}


def test_matching_of_more_than_two_truths_is_the_best(spark, tables):
    d, _, truths, predictions = tables
    assert min(map(len, truths.values())) >= 3 and max(map(len, predictions.values())) >= 3
    found = {}
    for m in registry.QUERIES["ordered_matching"](spark, d).collect():
        found.setdefault(m.video, []).append((m.truth_index, m.prediction_index))
    assert max(i for pairs in found.values() for i, _ in pairs) > 2
    for user, pairs in found.items():
        pairs.sort()
        assert [j for _, j in pairs] == sorted({j for _, j in pairs}) and len({i for i, _ in pairs}) == len(pairs)
        values = [iou(truths[user][i - 1], predictions[user][j - 1]) for i, j in pairs]
        assert all(values) and (round(sum(values), 12), len(values)) == best_by_brute_force(truths[user], predictions[user])


def test_labels_details_and_metrics_meet_all_truths(spark, tables):
    d, rows, truths, predictions = tables
    label = {r.event_id: r.inside for r in registry.QUERIES["interval_label_join"](spark, d).collect()}
    assert label == {row[0]: int(row[3] == "purchase") for row in rows}
    details = registry.QUERIES["segment_details"](spark, d).collect()
    for user in truths:
        mine = [x for x in details if x.video == user]
        assert sorted((x.truth_start, x.truth_end) for x in mine if x.truth_index) == truths[user]
        assert sorted((x.prediction_start, x.prediction_end) for x in mine if x.prediction_index) == predictions[user]
    detected = sum(x.status == "detected" for x in details)
    total = registry.QUERIES["segment_metrics"](spark, d).first()
    assert (total.truth_segments, total.detected_segments) == (sum(map(len, truths.values())), detected)
    assert total.gap_duration == sum(b[0] - a[1] for found in truths.values() for a, b in zip(found, found[1:]))
    series = registry.QUERIES["segment_metrics_by_video"](spark, d).collect()
    assert {x.video: x.truth_segments for x in series} == {user: len(found) for user, found in truths.items()}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables")
@pytest.mark.parametrize("name", ["interval_label_join", "segment_iou_pairs", "ordered_matching", "segment_details", "segment_metrics_by_video", "segment_metrics"])
def test_equal_their_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    got = registry.QUERIES[name](spark, DATA)
    want = connection.sql(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    key = lambda row: [(x is None, x) for x in row]
    rows = lambda found: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in found), key=key)
    assert rows(got.collect()) == rows(want)
