import random

import pytest
from pyspark.sql import functions as F

from spanwright.operators import segments as sg


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def frame(spark, data):
    return spark.createDataFrame(data, "video string, t double, score double")


def test_islands_close_at_the_next_row_or_one_step_after_the_last(spark):
    data = frame(spark, [("a", 0.0, 0.0), ("a", 2.0, 1.0), ("a", 4.0, 1.0), ("a", 6.0, 0.0), ("a", 8.0, 1.0), ("b", 5.0, 1.0)])
    found = sg.islands(data, F.col("score") >= 0.5)
    assert rows(found, "video", "start", "end") == [("a", 2.0, 6.0), ("a", 8.0, 10.0), ("b", 5.0, 5.0)]


def test_merge_then_least_duration(spark):
    data = spark.createDataFrame([("a", 0.0, 10.0), ("a", 16.0, 20.0), ("a", 27.0, 30.0)], "video string, start double, end double")
    assert rows(sg.merged(data, 6.0), "start", "end") == [(0.0, 20.0), (27.0, 30.0)]
    assert rows(sg.merged(data, 6.0, 8.0), "start", "end") == [(0.0, 20.0)]
    with pytest.raises(ValueError):
        sg.merged(data, -1.0)


def test_smoothing_uses_the_rows_there_are_at_edges(spark):
    data = frame(spark, [("a", float(i), s) for i, s in enumerate((1.0, 0.0, 0.0, 1.0))])
    found = [r.smoothed for r in sg.smoothed(data, 3).orderBy("t").collect()]
    assert found == pytest.approx([0.5, 1 / 3, 1 / 3, 0.5])
    with pytest.raises(ValueError):
        sg.smoothed(data, 4)


def test_chain_against_a_loop(spark):
    r = random.Random(3)
    data = [(v, float(2 * i), float(r.random() < 0.5)) for v in "abc" for i in range(60)]
    expected = []
    for v in "abc":
        scores = [s for w, _, s in data if w == v]
        runs, start = [], None
        for i, s in enumerate([*scores, 0.0]):
            if s and start is None:
                start = 2.0 * i
            elif not s and start is not None:
                runs.append([start, 2.0 * i])
                start = None
        joined = []
        for a, b in runs:
            if joined and a - joined[-1][1] <= 2.0:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        expected += [(v, a, b) for a, b in joined if b - a >= 6.0]
    found = sg.merged(sg.islands(frame(spark, data), F.col("score") >= 0.5), 2.0, 6.0)
    assert rows(found, "video", "start", "end") == sorted(expected)


def test_score_column_falls_back():
    class Named:
        def __init__(self, *columns):
            self.columns = list(columns)

    assert sg.score_column(Named("score", "pred_label"), 0.7) == ("score", 0.7)
    assert sg.score_column(Named("score", "smoothed_score"), 0.7) == ("smoothed_score", 0.7)
    assert sg.score_column(Named("pred_label"), None) == ("pred_label", 0.5)
    with pytest.raises(ValueError):
        sg.score_column(Named("score"), None)


def test_order_faults_and_sessions(spark):
    data = frame(spark, [("a", 0.0, 0.0), ("a", 0.0, 0.0), ("a", -1.0, 0.0), ("b", 1.0, 0.0), ("b", 9.0, 0.0), ("b", 12.0, 0.0)])
    assert sg.order_faults(data).count() == 2
    assert rows(sg.sessions(data.filter("video = 'b'"), 5.0), "start", "end", "n") == [(1.0, 1.0, 1), (9.0, 12.0, 2)]


def test_split_of_a_map_and_labels_of_overlapping_ranges(spark):
    from spanwright.operators.dataset import drawn_split, with_split
    from spanwright.operators.intervals import labelled

    names = [f"v{i}" for i in range(20)]
    splits = drawn_split(names)
    frames = spark.createDataFrame([(n, float(t)) for n in names for t in range(3)], "video string, t double")
    got = with_split(frames, splits).collect()
    assert len(got) == 60 and all(x.split == splits[x.video] for x in got)
    ranges = spark.createDataFrame([("v0", 0.0, 10.0), ("v0", 1.0, 2.0), ("v0", 5.0, 5.0), ("v0", 12.0, 13.0), ("v1", 3.0, 4.0)], "video string, start double, end double")
    points = spark.createDataFrame([("v0", float(t)) for t in range(-1, 15)] + [("v1", 3.5), ("v2", 3.5), ("v0", None)], "video string, t double")
    inside = {(x.video, x.t): x.label for x in labelled(points, ranges).collect()}
    assert all(inside["v0", float(t)] == int(0 <= t < 10 or t == 12) for t in range(-1, 15)) and inside["v1", 3.5] == 1 and inside["v2", 3.5] == inside["v0", None] == 0


def test_a_split_or_all_or_an_error(spark):
    import pytest

    from spanwright.operators.evaluation import of_split

    rows = spark.createDataFrame([(1, "train"), (2, "val")], "k int, split string")
    assert [x.k for x in of_split(rows, "val").collect()] == [2] and of_split(rows, "ALL").count() == 2
    with pytest.raises(ValueError):
        of_split(rows, "test")


def test_series_without_truth_or_prediction_have_a_row(spark):
    from spanwright.operators import evaluation as ev

    kind = "video string, start double, end double"
    truths, predictions = spark.createDataFrame([("a", 0.0, 10.0)], kind), spark.createDataFrame([("a", 1.0, 10.0), ("b", 0.0, 5.0)], kind)
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "video string")
    series = ev.by_series(ev.details(truths, predictions), keys=keys, sums=True)
    got = {x.video: (x.truth_segments, x.predicted_segments, x.detected_segments, x.mean_iou_all, x.exact_detection) for x in series.collect()}
    assert got == {"a": (1, 1, 1, 0.9, True), "b": (0, 1, 0, None, False), "c": (0, 0, 0, None, True)}
    total = ev.overall(series).first()
    assert (total.n_series, total.truth_segments, total.predicted_segments, total.start_mae) == (3, 1, 2, 1.0)
