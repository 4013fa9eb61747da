import pytest
from pyspark.sql import functions as F

from spanwright.operators import calibration as cal
from spanwright.operators import dataset as ds


def test_sweep_equals_counting(spark):
    data = [(i % 3 == 0, (i * 37 % 100) / 100) for i in range(200)] + [(True, float("nan")), (False, None)]
    frames = spark.createDataFrame([(int(y), s) for y, s in data], "label int, score double")
    grid = cal.threshold_grid()
    for r in cal.sweep(frames, grid).collect():
        on = [(y, s is not None and s == s and s >= r.threshold) for y, s in data]
        assert (r.tp, r.fp, r.tn, r.fn) == tuple(sum(1 for y, p in on if (p, bool(y)) == c) for c in ((True, True), (True, False), (False, False), (False, True)))


def test_zero_denominators_give_zero(spark):
    r = cal.confusion(spark.createDataFrame([(0, 0.1)], "label int, score double"), F.col("score") >= 0.5).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_downsampling_is_exact(spark):
    frames = spark.createDataFrame([("v", float(i), int(i < 7)) for i in range(500)], "video string, t double, label int")
    got = ds.downsampled(frames, 5)
    assert (got.filter("label = 1").count(), got.filter("label = 0").count()) == (7, 35)
    assert ds.downsampled(frames, 500).count() == 500


def test_drawn_split():
    ids = [f"v{i:02d}" for i in range(30)]
    split = ds.drawn_split(ids)
    assert [list(split.values()).count(n) for n in ("test", "val", "train")] == [4, 4, 22]
    assert split == ds.drawn_split(ids[::-1])
    assert ds.drawn_split(ids, test_ids=("v03",))["v03"] == "test"
    with pytest.raises(ValueError):
        ds.drawn_split(["a"])
    with pytest.raises(ValueError):
        ds.drawn_split(ids, val_ids=("none",))


def test_leaks_and_repeats(spark):
    rows = spark.createDataFrame([("a", "val"), ("a", "test"), ("b", "val"), ("b", "val")], "video string, split string")
    assert [r.video for r in ds.split_leaks(rows).collect()] == ["a"]
    assert [(r.video, r.extra) for r in ds.repeated_keys(rows, ["video", "split"]).collect()] == [("b", 1)]
