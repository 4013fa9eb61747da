import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanwright.operators import training as tr
from spanwright.sources import media, sinks, tables

COLUMNS = tables.DETECTION_COLUMNS


def detection(**values):
    row = {"video": "v", "text": " 7 ", "text_type": "text", "segment_index": "1", "segment_start_seconds": "0", "segment_end_seconds": "9.5", "frame_index": "3", "timestamp_seconds": "1.5", "score": "0.9", "center_x_norm": "0.5", "center_y_norm": "1"}
    return tuple((row | values)[c] for c in COLUMNS)


def loaded(spark, *rows):
    return tables.detections(spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in COLUMNS)))


def test_detections_are_checked(spark):
    got = loaded(spark, detection(), detection(text="  "), detection(text="Ann", score="1e-2")).collect()
    assert [(r.text, r.segment_index, r.frame_index, r.score, r.x, r.y) for r in got] == [("7", 1, 3, 0.9, 0.5, 1.0), ("Ann", 1, 3, 0.01, 0.5, 1.0)]
    assert got[0].row_id < got[1].row_id
    for bad in ({"score": "1.1"}, {"score": "nan"}, {"center_x_norm": "-0.1"}, {"timestamp_seconds": "inf"}, {"frame_index": "x"}, {"segment_index": None}):
        with pytest.raises(Exception, match=f"not a {next(iter(bad))}"):
            loaded(spark, detection(**bad)).collect()
    with pytest.raises(ValueError, match="no detections"):
        loaded(spark)
    with pytest.raises(ValueError, match="center_y_norm"):
        tables.detections(spark.createDataFrame([("v",)], "video string"))


def test_jobs_are_checked(spark):
    files = spark.createDataFrame([("a.mp4",), ("out/x.mp4",)], "path string")
    jobs = lambda *rows: spark.createDataFrame(list(rows), "source string, output string")
    assert sinks.checked_jobs(jobs(("a.mp4", "out/y.mp4")), files).count() == 1
    assert sinks.checked_jobs(jobs(("a.mp4", "out/x.mp4")), files, overwrite=True).count() == 1
    for rows, fault in (([("a.mp4", "out/x.mp4")], "already there: out/x.mp4"), ([("b.mp4", "out/y.mp4")], "no such source: b.mp4"), ([("a.mp4", "o"), ("a.mp4", "o")], "several jobs write: o")):
        with pytest.raises(ValueError, match=fault):
            sinks.checked_jobs(jobs(*rows), files)


def test_clip_commands_and_json(spark, tmp_path):
    command = sinks.clip_command("a.mp4", 1.0, 2.5, "b.mp4")
    assert command[-1] == "b.mp4" and command[command.index("-preset") + 1] == "fast" and command.count("-map") == 2 and "+faststart" in command
    assert sinks.clip_command("a", 0, 1, "b", copy=True)[-5:-1] == ["-c", "copy", "-avoid_negative_ts", "make_zero"]
    rows = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    assert sinks.printed(rows.orderBy("a"), "rows", most=1) == "rows\na=1  b=é\n..."
    assert sorted(r.json for r in sinks.as_json(rows).collect()) == ['{"a":1,"b":"é"}', '{"a":2,"b":null}']
    sinks.write_json(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_paths_and_missing_files(spark):
    files = spark.createDataFrame([("/v/a.mp4",), ("/p/a.mp4",), ("/p/b.mp4",)], "path string")
    rows = spark.createDataFrame([("a.mp4",), ("b.mp4",), ("c.mp4",), ("/x/d.mp4",)], "video string")
    got = {r.video: r.source for r in tables.resolved_paths(rows, files, "/v", "/p/").collect()}
    assert got == {"a.mp4": "/v/a.mp4", "b.mp4": "/p/b.mp4", "c.mp4": "/v/c.mp4", "/x/d.mp4": "/x/d.mp4"}
    frames = spark.createDataFrame([("/v/a.mp4",), ("/n/2",), ("/n/1",), ("/n/1",), (None,)], "frame_path string")
    assert tables.missing_files(frames, files) == (2, ["/n/1", "/n/2"]) and tables.missing_files(frames, files, most=1) == (2, ["/n/1"])


def test_one_row_of_each_key(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "name string, place int, path string")
    assert sorted(r.path for r in tables.one_of_each(rows, "name", ["place"]).collect()) == ["y", "z"]
    assert sorted(r.path for r in tables.one_of_each(rows, "name", ["place"], last=False).collect()) == ["x", "z"]


def test_checkpoints(spark, tmp_path):
    good = {"architecture": "linear", "image_size": 8, "threshold": 0.5, "raw_threshold": 0.4, "smoothing_window": 5, "weights": [1.0]}
    (tmp_path / "c.json").write_text(json.dumps(good))
    assert tables.checkpoint(spark, str(tmp_path / "c.json"), "linear") == good
    with pytest.raises(ValueError):
        tables.checkpoint(spark, str(tmp_path / "c.json"), "other")


def picture(width, height, value):
    return b"P6\n# made\n%d %d\n255\n" % (width, height) + bytes([value, 0, 255]) * (width * height)


def test_images(spark, tmp_path):
    folder = tmp_path / "frames"
    folder.mkdir()
    (folder / "a.ppm").write_bytes(picture(5, 3, 51))
    (folder / "b.PGM").write_bytes(b"P5 2 2 255\n" + bytes([0, 255, 255, 0]))
    (folder / "c.txt").write_bytes(b"no image")
    got = {r.path.rsplit("/", 1)[1]: r for r in media.images(spark, str(folder), size=2).collect()}
    assert sorted(got) == ["a.ppm", "b.PGM"] and (got["a.ppm"].width, got["a.ppm"].height) == (5, 3)
    assert got["a.ppm"].pixels == pytest.approx([0.2, 0, 1] * 4) and got["b.PGM"].pixels == pytest.approx([0] * 3 + [1] * 6 + [0] * 3)
    (folder / "d.ppm").write_bytes(b"P6 9 9 255\nshort")
    with pytest.raises(Exception, match="portable pixmap"):
        media.images(spark, str(folder)).collect()
    faults = [r for r in media.images(spark, str(folder), size=2, faults=True).collect() if r.fault]
    assert len(faults) == 1 and faults[0].pixels is None
    paths = spark.createDataFrame([(str(folder / "a.ppm"),), (str(folder / "z.ppm"),)], "frame_path string")
    assert media.images_missing(paths, str(folder)) == [str(folder / "z.ppm")]


def test_frames_of_videos(spark):
    class Film:
        def __init__(self, path):
            self.path, self.at = path, -1.0

        def frame(self, milliseconds):
            assert milliseconds > self.at
            self.at = milliseconds
            return f"{self.path}@{milliseconds:.0f}".encode() if milliseconds < 2600 else None

        def close(self):
            self.path = None

    videos = spark.createDataFrame([("a", "/a.mp4", 0.0, 2.0), ("b", "/b.mp4", 1.0, 4.0)], "video string, path string, start double, end double")
    got = sorted((r.video, r.frame_index, r.t, r.name, bytes(r.picture).decode()) for r in media.video_frames(videos, Film, 2.0).collect())
    assert [g[1:3] for g in got if g[0] == "a"] == [(1, 0.0), (2, 0.5), (3, 1.0), (4, 1.5)]
    assert [g[2] for g in got if g[0] == "b"] == [1.0, 1.5, 2.0, 2.5] and got[-1][3:] == ("frame_000004_t0000002500.jpg", "/b.mp4@2500")


def test_early_stop():
    stop, seen = tr.EarlyStop(2), []
    for value in ((0.5, 0.1), (0.5, 0.2), (0.4, 0.9), (0.5, 0.2), (0.9, 0.9)):
        seen.append(stop.improved(value))
        if stop.over:
            break
    assert seen == [True, True, False, False] and stop.best == (0.5, 0.2)


def test_training_separates_and_stops(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 4))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.8).astype(int)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(600)], "id long, features array<double>, label int").repartition(4)
    val = rows.filter("id % 4 = 0")
    found = tr.train(rows.filter("id % 4 <> 0"), val, [tr.Stage(6, 0.3, (0,)), tr.Stage(8, 0.3)], patience=3)
    assert found.metrics[0] > 0.9 and found.weights[0] > abs(found.weights[2]) and len(found.epochs) <= 14
    assert found.metrics == max((e["f1"], e["recall"], e["precision"]) for e in found.epochs)
    again = tr.train(rows.filter("id % 4 <> 0"), val, [tr.Stage(3, 0.3)], augment=True, seed=5)
    assert again.weights == pytest.approx(tr.train(rows.filter("id % 4 <> 0").coalesce(1), val, [tr.Stage(3, 0.3)], augment=True, seed=5).weights)
    first = tr.train(rows, val, [tr.Stage(2, 0.3, (1,))])
    assert first.weights[0] == 0 and first.weights[1] != 0
    with pytest.raises(ValueError, match="both labels"):
        tr.train(rows.filter("label = 1"), val, [tr.Stage(1, 0.1)])
    flat, mean, spread = tr.normalised(rows)
    assert np.allclose(np.array([r.features for r in flat.sort("id").collect()]), (x - mean) / spread) and np.allclose(mean, x.mean(axis=0))
    scores = tr.scored(rows, found.weights, found.bias).agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] < scores[1] <= 1
