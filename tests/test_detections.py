import itertools
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from spanwright.functions.text import NUMBER, plain
from spanwright.operators import detections as det
from spanwright.operators import resolve as rs
from spanwright.operators import scoring as sc


def number(i, frame, text, x, y, score=0.9, time=None):
    return rs.Row(i, frame, frame / 2 if time is None else time, text, NUMBER, score, x, y, norm=plain(text))


def name(i, frame, text, x, y, score=0.9, time=None):
    return rs.Row(i, frame, frame / 2 if time is None else time, text, "text", score, x, y, norm=plain(text))


def test_nearest_number_of_a_name(spark):
    kind = "video string, frame_index long, row_id long, text string, text_type string, score double, x double, y double"
    rows = spark.createDataFrame([("v", 1, 1, "7", NUMBER, 0.9, 0.10, 0.50), ("v", 1, 2, "Ann", "text", 0.9, 0.20, 0.505), ("v", 1, 3, "Bob", "text", 0.9, 0.12, 0.53)], kind)
    got = det.numbers_left_of_names(det.names_of(rows), det.numbers_of(rows)).collect()
    assert [(r.n_text, r.o_text) for r in got] == [("Ann", "7")]


def test_unnested_arrays(spark):
    rows = spark.createDataFrame([(["7", " ", "Ann"], [0.9, 0.99, 0.5], [[0, 0, 10, 10]] * 3, 100, 100)], "texts array<string>, scores array<double>, boxes array<array<int>>, frame_width int, frame_height int")
    got = det.unnested(rows).collect()
    assert [(r.text, r.text_type, r.center_x_norm) for r in got] == [("7", NUMBER, 0.05)]
    with pytest.raises(Exception, match="different lengths"):
        det.unnested(rows.withColumn("scores", F.array(F.lit(0.9)))).collect()


def test_consensus_prefers_frames_then_score_then_first():
    assert rs.consensus([("Jones", 0.9, 1), ("Jones", 0.9, 2), ("JONES.", 0.8, 3)]) == ("Jones", pytest.approx(2.6 / 3), 3)
    assert rs.consensus([("Ann", 0.5, 1), ("Zed", 0.9, 1)])[0] == "Zed"
    assert rs.consensus([("Ann", 0.5, 1), ("Zed", 0.5, 1)])[0] == "Ann"
    assert rs.consensus([]) == ("", 0.0, 0)


def test_clusters_follow_their_median():
    rows = [number(i, i, "7", 0.10 + 0.03 * i, 0.5) for i in range(3)]
    assert [len(c.rows) for c in rs.clusters(rows)] == [3]
    assert [len(c.rows) for c in rs.clusters([number(1, 1, "7", 0.1, 0.1), number(2, 1, "8", 0.2, 0.1)])] == [1, 1]


def test_anchors_use_a_name_once():
    rows = [number(1, 1, "7", 0.5, 0.5), number(2, 1, "8", 0.52, 0.5), name(3, 1, "Ann", 0.51, 0.56)]
    assert [(n.row_id, m.row_id) for n, m in rs.anchors(rows)] == [(1, 3)]


def table_rows(five=False):
    """Three players in two frames; or five in three, without and with the last number."""
    out, last, i = [], [], 0
    for frame in (1, 2, 3) if five else (1, 2):
        for k, who in enumerate(("Alpha Ray", "Bravo Kim", "Carol Dunn", "Dora Quist", "Emil Voss")[: 5 if five else 3]):
            (last if k == 4 else out).append(number(i, frame, str(k + 1), 0.1, 0.2 + 0.1 * k))
            out.append(name(i + 1, frame, who, 0.2, 0.2 + 0.1 * k))
            i += 2
    return (out, last) if five else out


def test_table_lineup():
    records, n = rs.table_lineup(table_rows(), 3)
    assert n == 3 and [(r["shirt_number"], r["player_name"], r["slot_index"]) for r in records] == [(1, "Alpha Ray", 1), (2, "Bravo Kim", 2), (3, "Carol Dunn", 3)]
    assert rs.table_lineup(table_rows(), 4) == ([], 3)


def formation_rows(start=1, frames=3, first=0, wide=False):
    out, i = [], first
    more = (("Quist", 0.2, 0.8), ("Voss", 0.5, 0.8), ("Yarrow", 0.68, 0.8)) if wide else ()
    for frame in range(start, start + frames):
        for k, (who, x, y) in enumerate((("Ray", 0.3, 0.2), ("Kim", 0.6, 0.2), ("Dunn", 0.45, 0.5), *more)):
            out += [number(i, frame, str(k + 4), x, y), name(i + 1, frame, who, x, y + 0.08)]
            i += 2
    return out


def test_formation_and_cascade():
    options = rs.Options(players=3, least_numbers=3)
    records, diagnosis = rs.resolve_segment(formation_rows(), 10.0, options)
    assert [(r["shirt_number"], r["player_name"], r["row_index"]) for r in records] == [(4, "Ray", 1), (5, "Kim", 1), (6, "Dunn", 2)]
    assert diagnosis["status"] == "resolved" and diagnosis["resolution_method"] == "formation"
    assert rs.resolve_segment(table_rows(), 10.0, options)[1]["resolution_method"] == "table"
    assert rs.resolve_segment([], 10.0, options)[1]["status"] == "unresolved"


class Reader:
    def __init__(self, table=(), formation=(), error=None):
        self.rows, self.error = {"table": list(table), "formation": list(formation)}, error

    def __call__(self):
        return self

    def table(self, rows, players):
        if self.error:
            raise self.error
        return self.rows["table"]

    def formation(self, rows):
        return self.rows["formation"]


def test_a_reader_completes_lineups():
    with_path = lambda rows: [replace(r, path="frame.png") for r in rows]
    rows, options = with_path(table_rows()), rs.Options(players=4, least_numbers=3)
    assert rs.resolve_segment(rows, 10.0, options)[1]["message"] == "table/list pass found 3/4 players; Only 3 player slots found for lineup 1; expected 4."
    alone = rs.Options(players=4, least_numbers=9)
    assert rs.resolve_segment(rows, 10.0, alone)[1]["message"] == "table/list pass found 3/4 players; no formation snapshot found"
    # Four or more players must be there for a table to be read again.
    five = rs.Options(players=5, least_numbers=3)
    known, last = table_rows(five=True)
    found, diagnosis = rs.resolve_segment(with_path(known), 10.0, five, Reader(table=last))
    assert diagnosis["resolution_method"] == "table+local_ocr" and [r["shirt_number"] for r in found] == [1, 2, 3, 4, 5]
    assert diagnosis["message"] == "table/list pass found 4/5 players; local table OCR added 3 number observations"
    assert rs.resolve_segment(known, 10.0, five, Reader(table=last))[1]["status"] == "unresolved"  # no images
    failed = rs.resolve_segment(with_path(known), 10.0, five, Reader(error=OSError("no model")))[1]
    assert "local table OCR unavailable: no model" in failed["message"] and failed["status"] == "unresolved"
    rows = with_path(formation_rows(wide=True))
    lost = [r for r in rows if r.text == "9"]
    four = rs.Options(players=6, least_numbers=5)
    records, diagnosis = rs.resolve_segment([r for r in rows if r not in lost], 10.0, four, Reader(formation=lost))
    assert diagnosis["resolution_method"] == "formation+local_ocr" and len(records) == 6 and {r["resolution_method"] for r in records} == {"formation+local_ocr"}
    assert diagnosis["message"] == "local formation OCR added 3 number observations"
    assert rs.retry_frames(formation_rows(), 3) == [1, 2, 3]


def test_options_are_checked():
    for bad in ({"players": 0}, {"least_numbers": 0}, {"same_gap": -1.0}, {"same_signature": 1.5}):
        with pytest.raises(ValueError):
            rs.Options(**bad).checked()


def test_stacks_equal_all_combinations():
    r = random.Random(6)
    for _ in range(200):
        rows = [name(i, r.randint(1, 2), r.choice(["Ann Lee", "Bob", "x", "Cy-Dee", "Eve"]), r.uniform(0, 0.15), r.uniform(0, 0.3)) for i in range(r.randint(0, 9))]
        want = []
        for frame, members in rs.by_frame(rows).items():
            usable = [m for m in members if rs.name_like(m.norm)]
            for size in (2, 3):
                for group in itertools.combinations(usable, size):
                    stack = sorted(group, key=lambda m: m.y)
                    if max(m.x for m in stack) - min(m.x for m in stack) <= 0.065 and stack[-1].y - stack[0].y <= 0.14 and all(b.y - a.y <= 0.09 for a, b in zip(stack, stack[1:])):
                        want.append((frame, tuple(m.row_id for m in stack)))
        assert [(s.frame, tuple(m.row_id for m in s.rows)) for s in rs.stacks(rows)] == want


def test_events_split_by_gap_and_by_signature():
    late = [rs.Row(**{**r.__dict__, "time": r.time + 60, "row_id": r.row_id + 100, "frame": r.frame + 50}) for r in formation_rows()]
    assert [len(e.frames) for e in rs.events(formation_rows() + late, rs.Options(least_numbers=3))] == [3, 3]
    assert rs.signature([number(1, 1, "7", 0.1, 0.1)], [number(2, 2, "7", 0.12, 0.1), number(3, 2, "7", 0.11, 0.1)]) == 1.0


def test_full_name_joins_a_neighbour():
    rows = [name(1, 1, "Harry", 0.5, 0.40), name(2, 1, "Kane", 0.5, 0.44)]
    assert rs.full_name("Kane", rows, set())[0] == "Harry Kane"
    assert rs.full_name("Kane", rows, {"harry"})[0] == "Kane"


def test_regular_rows():
    rows = [rs.Row(i, 1, 0.0, w, "text", 0.9, 0.3, y, 30.0, 100.0, plain(w)) for i, (w, y) in enumerate((("Ann", 0.1), ("Bob", 0.15), ("Cy Lee", 0.2), ("Dee", 0.4)))]
    assert [r.text for r in rs.regular_rows(rows, 0.3, 3)] == ["Ann", "Bob", "Cy Lee"]


def test_models_behind_interfaces(spark):
    frames = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 1.0])], "id int, features array<double>")
    got = sc.scored(frames, lambda: lambda v: v.sum(axis=1) / 10).orderBy("id").collect()
    assert [round(r.score, 6) for r in got] == [0.3, 0.1]
    images = spark.createDataFrame([("a",), ("b",)], "frame_path string")
    read = sc.recognised(images, lambda: lambda paths: [([p], [0.9], [[0, 0, 1, 1]]) for p in paths])
    assert sorted(r.texts[0] for r in read.collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        sc.checked_checkpoint({"architecture": "x"}, "x")


class Screen:
    """An image whose numbers are known by the place of a crop."""

    def __init__(self, numbers, hard=()):
        import numpy as np

        self.numbers, self.hard, self.calls = numbers, hard, []
        self.pixels = np.zeros((1000, 1000, 1), int)
        for value, x, y in numbers:
            self.pixels[int(y * 1000), int(x * 1000)] = value

    def reader(self, **parts):
        from spanwright.operators.reread import ImageReader

        return ImageReader(lambda path: self.pixels if path == "frame.png" else None, self.read, **parts)

    def found(self, crop, hard):
        values = sorted(set(crop.reshape(-1).tolist()) - {0})
        return [(str(v), 0.9) for v in values if (v in self.hard) == hard]

    def read(self, crops):
        self.calls.append(len(crops))
        return [self.found(c, False) for c in crops]


def test_numbers_are_read_again_in_images():
    rows = [replace(r, path="frame.png", x1=r.x * 1000, width=1000.0) for r in table_rows(five=True)[0]]
    options = rs.Options(players=5, least_numbers=5)
    rows = [replace(r, y=r.y * 0.6) for r in rows]
    screen = Screen([(k + 1, 0.1, (0.2 + 0.1 * k) * 0.6) for k in range(5)])
    reader = screen.reader()
    records, diagnosis = rs.resolve_segment(rows, 10.0, options, lambda: reader)
    assert diagnosis["resolution_method"] == "table+local_ocr" and [r["shirt_number"] for r in records] == [1, 2, 3, 4, 5] and screen.calls == [5, 5, 5]
    rows = [replace(r, path="frame.png") for r in formation_rows(wide=True)]
    lost = [r for r in rows if r.text in ("8", "9")]
    rows = [replace(r, y=r.y - 0.15) for r in rows if r not in lost]
    screen = Screen([(8, 0.5, 0.67), (9, 0.68, 0.67)], hard=(9,))
    one = screen.reader(recognise=lambda crops: [screen.found(c, True) for c in crops])
    more = one.formation(rows)
    assert sorted((r.text, r.frame) for r in more) == sorted((t, f) for t in ("8", "9") for f in (1, 2, 3)) and min(r.row_id for r in more) > max(r.row_id for r in rows)
    assert all(abs(r.y - (0.65 + 0.08 - 0.058)) < 1e-6 for r in more) and screen.calls == [6, 5] * 3
    assert screen.reader().formation([replace(r, path="other") for r in rows]) == []


def test_frames_of_a_table_are_the_earliest_and_the_fullest():
    from spanwright.operators.reread import table_frames

    pair = lambda f: rs.Pair(1, "a", 0.9, 0.9, f, 0.0, 0.1, 0.1, 0.1)
    counts = {1: 3, 2: 4, 3: 9, 4: 5, 5: 9}
    pairs = [pair(f) for f, n in counts.items() for _ in range(n)] + [replace(pair(9), apart=False)] * 20
    assert [f for f, _ in table_frames(pairs)] == [2, 3, 5] and table_frames([]) == []
