import pytest
from pyspark.sql import functions as F

from spanwright.functions import text as tx
from spanwright.functions import timetext as tt
from spanwright.sources import sinks, tables


def values(spark, texts, column):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("text"))).collect()]


def test_times(spark):
    texts = ["1.0", "90:75", "1:30", "00:01:30.5", "x", "1_000", "nan", None]
    assert values(spark, texts, tt.seconds_of) == [1.0, None, 90.0, 90.5, None, None, None, None]
    assert values(spark, ["90:75"], lambda c: tt.seconds_of(c, strict=False)) == [5475.0]
    with pytest.raises(Exception, match="not a time"):
        values(spark, ["x"], tt.checked_seconds)


def test_ranges_and_clocks(spark):
    got = values(spark, ["3.30-3.52", "1.00 - 00:02:00", "2.00-1.00", "1.75-3.00"], tt.range_of)
    assert [g and tuple(g) for g in got] == [(210.0, 232.0), (60.0, 120.0), None, None]
    clocks = spark.createDataFrame([(61.5,), (3600.0,), (59.9996,)], "t double").select(tt.clock_of(F.col("t")), tt.tag_of(F.col("t"))).collect()
    assert [tuple(r) for r in clocks] == [("00:01:01.5", "00-01-01-500"), ("01:00:00", "01-00-00"), ("00:01:00", "00-01-00")]


def test_frame_names(spark):
    rows = spark.createDataFrame([(7, 20), (1_000_000, 10_000_000_000)], "i long, ms long")
    i, ms = F.col("i"), F.col("ms")
    got = rows.orderBy("i").select(tt.frame_name(i), tt.frame_name(i, ms), tt.frame_name(i, fixed=True), tt.frame_name(i, ms, fixed=True)).collect()
    assert tuple(got[0]) == ("frame_000007.jpg", "frame_000007_t0000000020.jpg") * 2
    assert tuple(got[1]) == ("frame_1000000.jpg", "frame_1000000_t10000000000.jpg", "frame_100000.jpg", "frame_100000_t1000000000.jpg")


def test_normalisation(spark):
    assert values(spark, ["Đội", "Ødegaard", "Straße", "Ｇ", "J. O'Neil-2", None], tx.normalized) == ["oi", "degaard", "strasse", "g", "j o neil 2", None]
    assert tx.alike("tide", "diet") == 0.25 and tx.alike("diet", "tide") == 0.5
    assert values(spark, ["a/b c.mp4", "", "..", "É x"], tx.safe_stem) == ["a_b_c.mp4", "video", "video", "E_x"]


def test_kinds(spark):
    assert values(spark, ["7", "0", "100", "²", "Kane"], tx.text_type) == [tx.NUMBER, tx.TEXT, tx.TEXT, tx.TEXT, tx.TEXT]
    got = values(spark, ["10  Kane", "0 Kane", "7 GK", "Kane"], tx.inline_player)
    assert [g and tuple(g) for g in got] == [(10, "Kane"), None, None, None]


def test_truth_ranges(spark):
    kind = "video string, one string, two string"
    good = tables.truth_ranges(spark.createDataFrame([(" a ", "1.00-1.30", "2.00-2.10")], kind))
    assert sorted((r.video, r.team, r.start, r.end) for r in good.collect()) == [("a", "one", 60.0, 90.0), ("a", "two", 120.0, 130.0)]
    for bad in ([("", "1.00-1.30", "2.00-2.10")], [("a", "1.00-1.30", "1.10-2.10")], [("a", "x", "1.10-2.10")], [("a", "1.00-1.30", "2.00-2.10")] * 2):
        with pytest.raises(Exception, match="name|range"):
            tables.truth_ranges(spark.createDataFrame(bad, kind)).collect()


def test_segment_table_and_clips(spark):
    rows = spark.createDataFrame([("v/x.mp4", "00:00:10", "00:00:20", None), ("v/x.mp4", "00:01:00.5", "00:01:10", " intro ")], "video string, start string, end string, segment string")
    table = tables.segment_table(rows)
    assert [(r.segment_index, r.segment, r.start) for r in table.orderBy("segment_index").collect()] == [(1, "lineup_01", 10.0), (2, "intro", 60.5)]
    jobs = sinks.clip_jobs(table, "out/").orderBy("number").collect()
    assert jobs[1].output == "out/x_lineup_02_00-01-00-500_to_00-01-10.mp4"
    assert sinks.repeated_outputs(sinks.clip_jobs(table)).count() == 0


def test_clip_export_replaces_whole_files(spark, tmp_path):
    def run(command, check):
        with open(command[-1], "w") as out:
            out.write(command[command.index("-t") + 1])

    target = str(tmp_path / "clips" / "a.mp4")
    sinks.export_clips(spark.createDataFrame([("s.mp4", 1.0, 2.5, target)], "source string, start double, duration double, output string"), run=run)
    assert open(target).read() == "2.500" and len(list((tmp_path / "clips").iterdir())) == 1


def test_csv_listing_and_selection(spark, tmp_path):
    for v in ("a", "b c"):
        (tmp_path / "labels" / v).mkdir(parents=True)
        (tmp_path / "labels" / v / "frame_labels.csv").write_text("video,frame_path,timestamp,timestamp_seconds,label\nx,p,00:00:00,0.0,1\n")
    got = tables.frame_labels(spark, f"{tmp_path}/labels/*/frame_labels.csv")
    assert sorted(r.video_id for r in got.collect()) == ["a", "b c"]
    (tmp_path / "videos").mkdir()
    for n in ("1.MP4", "2.txt", "3.mkv"):
        (tmp_path / "videos" / n).write_text("x")
    files = tables.listed_files(spark, f"{tmp_path}/videos").withColumn("name", tx.path_name(F.col("path")))
    assert sorted(r.name for r in files.collect()) == ["1.MP4", "3.mkv"]
    assert [r.request_index for r in tables.chosen(files, ["3.mkv"]).collect()] == [0]
    with pytest.raises(ValueError, match="none"):
        tables.chosen(files, ["none"])
