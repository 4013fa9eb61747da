import itertools
import random

import pytest

from spanwright.operators import evaluation as ev
from spanwright.operators import intervals as iv


def iou(a, b):
    both = max(0.0, min(a[1], b[1]) - max(a[0], b[0]))
    return both / (a[1] - a[0] + b[1] - b[0] - both) if both else 0.0


def test_matching_reaches_the_best_sum():
    r = random.Random(1)

    def spans(n):
        points = sorted(r.sample(range(40), 2 * n))
        return [(float(points[2 * i]), float(points[2 * i + 1])) for i in range(n)]

    for _ in range(300):
        a, b = spans(r.randint(0, 4)), spans(r.randint(0, 4))
        best = (0.0, 0)
        for k in range(min(len(a), len(b)) + 1):
            for i in itertools.combinations(range(len(a)), k):
                for j in itertools.combinations(range(len(b)), k):
                    values = [iou(a[x], b[y]) for x, y in zip(i, j, strict=True)]
                    if all(values):
                        best = max(best, (round(sum(values), 12), k))
        found = iv.best_matching(a, b)
        assert (round(sum(iou(a[x], b[y]) for x, y in found.items()), 12), len(found)) == best


def test_matching_keeps_order_and_one_to_one():
    assert iv.best_matching([(0, 10), (20, 30)], [(0, 9), (18, 31)]) == {0: 0, 1: 1}
    assert iv.best_matching([(0, 10), (20, 30)], [(5, 30)]) == {1: 0}


def test_labels_are_half_open(spark):
    points = spark.createDataFrame([("a", 9.0), ("a", 10.0), ("a", 20.0), ("b", 10.0)], "video string, t double")
    ranges = spark.createDataFrame([("a", 10.0, 20.0)], "video string, start double, end double")
    assert sorted((r.video, r.t, r.label) for r in iv.labelled(points, ranges).collect()) == [("a", 9.0, 0), ("a", 10.0, 1), ("a", 20.0, 0), ("b", 10.0, 0)]


def test_grid(spark):
    windows = spark.createDataFrame([("a", 1.0, 2.2)], "video string, start double, end double")
    assert [(r.frame_index, r.t) for r in iv.time_grid(windows, 2.0).orderBy("t").collect()] == [(1, 1.0), (2, 1.5), (3, 2.0)]


def test_details_and_metrics(spark):
    kind = "video string, start double, end double"
    truths = spark.createDataFrame([("a", 0.0, 10.0), ("a", 20.0, 30.0), ("b", 0.0, 5.0)], kind)
    predictions = spark.createDataFrame([("a", 0.0, 9.0), ("a", 12.0, 14.0), ("a", 29.0, 40.0), ("c", 0.0, 1.0)], kind)
    found = ev.details(truths, predictions)
    status = sorted((r.video, r.truth_index or 0, r.prediction_index or 0, r.status) for r in found.collect())
    assert status == [("a", 0, 2, "extra_prediction"), ("a", 1, 1, "detected"), ("a", 2, 3, "below_iou_threshold"), ("b", 1, 0, "missed"), ("c", 0, 1, "extra_prediction")]
    series = {r.video: r for r in ev.by_series(found).collect()}
    a = series["a"]
    assert (a.detected_segments, a.false_positive_segments, a.missed_segments) == (1, 2, 1)
    assert a.gap_duration == 10.0 and a.gap_false_positive == 2.0 and a.gap_preservation == pytest.approx(0.8)
    assert series["b"].gap_preservation is None and not series["b"].all_detected
