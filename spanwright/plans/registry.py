"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.functions import text as tx
from spanwright.functions import timetext as tt
from spanwright.operators import calibration as cal
from spanwright.operators import dataset as ds
from spanwright.operators import detections as det
from spanwright.operators import evaluation as ev
from spanwright.operators import intervals as iv
from spanwright.operators import resolve as rs
from spanwright.operators import scoring as sc
from spanwright.operators import segments as sg
from spanwright.plans import views as v
from spanwright.operators import training as tr
from spanwright.sources import sinks, tables
from spanwright.sources.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# Segments.


@query(f'WITH {v.PREDICTIONS} SELECT video, "start" AS start_seconds, "end" AS end_seconds FROM predictions')
def flagship_segments(spark, d):
    return v.predictions(spark, d).select("video", F.col("start").alias("start_seconds"), F.col("end").alias("end_seconds"))


def _smooth(w: int):
    def run(spark, d):
        return sg.smoothed(v.frames(spark, d), w).select("event_id", "video", F.round("smoothed", 9).alias("smoothed"))

    run.__name__ = f"smooth_centered_{w}"
    query(f"WITH {v.FRAMES} SELECT event_id, video, round({v.smooth_sql(w)}, 9) AS smoothed FROM frames")(run)


for _w in (3, 5, 7):
    _smooth(_w)


@query(f"""WITH {v.FRAMES}, g AS (SELECT video, t - lag(t) OVER (PARTITION BY video ORDER BY t) AS gap FROM frames)
SELECT video, round(coalesce(median(gap) FILTER (gap > 0), 0), 6) AS step FROM g GROUP BY video""")
def frame_step_median(spark, d):
    return sg.steps(v.frames(spark, d)).select("video", F.round("step", 6).alias("step"))


@query(f'WITH {v.RAW_SEGMENTS} SELECT video, "start" AS start_seconds, "end" AS end_seconds FROM raw')
def islands(spark, d):
    found = sg.islands(sg.smoothed(v.frames(spark, d), 5), F.col("smoothed") >= 0.5)
    return found.select("video", F.col("start").alias("start_seconds"), F.col("end").alias("end_seconds"))


@query(f"""WITH {v.TRUTHS}, {v.merged_sql("out_", "truths", 21600.0, 3600.0)}
SELECT video, "start" AS start_seconds, "end" AS end_seconds FROM out_""")
def merge_gap_min_duration(spark, d):
    runs = sg.islands(v.frames(spark, d), F.col("event_type").isin("purchase", "view"))
    return sg.merged(runs, 21600.0, 3600.0).select("video", F.col("start").alias("start_seconds"), F.col("end").alias("end_seconds"))


@query(f"WITH {v.FRAMES}, o AS (SELECT *, lag(t) OVER (PARTITION BY video ORDER BY t) AS b FROM frames) SELECT video, t FROM o WHERE t <= b OR t < 0 OR t IS NULL")
def monotonic_check(spark, d):
    return sg.order_faults(v.frames(spark, d)).select("video", "t")


@query(f"""WITH {v.FRAMES},
a AS (SELECT video, t, CASE WHEN coalesce(t - lag(t) OVER (PARTITION BY video ORDER BY t) > 21600, true) THEN 1 ELSE 0 END AS fresh FROM frames),
b AS (SELECT video, t, sum(fresh) OVER (PARTITION BY video ORDER BY t) AS session FROM a)
SELECT video, session::BIGINT AS session, min(t) AS start_seconds, max(t) AS end_seconds, count(*) AS n FROM b GROUP BY video, session""")
def events_by_gap(spark, d):
    found = sg.sessions(v.frames(spark, d), 21600.0)
    return found.select("video", F.col("session").cast("long").alias("session"), F.col("start").alias("start_seconds"), F.col("end").alias("end_seconds"), "n")


# Labels and intervals.


@query(f"""WITH {v.TRUTHS} SELECT event_id, video,
  (EXISTS (SELECT 1 FROM truths r WHERE r.video = f.video AND r."start" <= f.t AND f.t < r."end"))::INT AS inside FROM frames f""")
def interval_label_join(spark, d):
    return iv.labelled(v.frames(spark, d), v.truths(spark, d), name="inside").select("event_id", "video", "inside")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  (l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 60 DAY)::INT AS inside
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def interval_label_orders(spark, d):
    day = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{v.EPOCH}', {c})") / 1e6
    start = day("o_orderdate")
    ranges = read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), start.alias("start"), (start + 60 * 86400.0).alias("end"))
    points = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", day("l_shipdate").alias("t"))
    return iv.labelled(points, ranges, key="l_orderkey", name="inside").drop("t")


@query("""WITH r AS (SELECT o_custkey AS video, o_orderkey, o_orderdate AS s, o_orderdate + INTERVAL 60 DAY AS e FROM orders)
SELECT video, o_orderkey FROM (SELECT *, max(e) OVER (PARTITION BY video ORDER BY s, e, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r) WHERE s < before""")
def overlap_check(spark, d):
    start = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{v.EPOCH}', o_orderdate)") / 1e6
    ranges = read(spark, d, "orders").select(F.col("o_custkey").alias("video"), "o_orderkey", start.alias("start"), (start + 60 * 86400.0).alias("end"))
    return iv.overlap_faults(ranges, order=("start", "end", "o_orderkey")).select("video", "o_orderkey")


@query(f"""WITH {v.FRAMES} SELECT split, video, count(*) AS n_rows, sum(label)::BIGINT AS n_positive, count(DISTINCT event_type) AS n_keys
FROM frames GROUP BY split, video""")
def label_summary(spark, d):
    return ds.summary(v.frames(spark, d), ["split", "video"], key="event_type")


@query("SELECT DISTINCT o_custkey AS video FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def unlabelled_anti(spark, d):
    series = read(spark, d, "orders").select(F.col("o_custkey").alias("video"))
    return ds.not_in(series, v.frames(spark, d))


@query("SELECT o_orderkey, o_custkey AS video FROM orders WHERE o_custkey IN (SELECT user_id FROM events)")
def only_truth_semi(spark, d):
    return ds.only_in(read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("video")), v.frames(spark, d)).select("o_orderkey", "video")


@query(f"""WITH {v.FRAMES}, w AS (SELECT video, min(t) AS s, min(t) + 600 + video % 7 AS e FROM frames GROUP BY video),
g AS (SELECT video, s, e, unnest(range(0, ceil((e - s) * 0.5 - 1e-9)::BIGINT)) AS i FROM w)
SELECT video, (i + 1)::INT AS frame_index, round(round(s + i / 0.5::DOUBLE, 6), 3) AS t FROM g WHERE round(s + i / 0.5::DOUBLE, 6) < e""")
def time_grid(spark, d):
    windows = v.frames(spark, d).groupBy("video").agg(F.min("t").alias("start"))
    windows = windows.withColumn("end", F.col("start") + 600 + F.col("video") % 7)
    return iv.time_grid(windows, 0.5).select("video", "frame_index", "t")


@query(f"WITH RECURSIVE {v.MATCHING} SELECT video, i::INT AS truth_index, j::INT AS prediction_index, round(iou, 9) AS iou FROM pairs")
def segment_iou_pairs(spark, d):
    found = ev.iou_pairs(v.truths(spark, d), v.predictions(spark, d))
    return found.select("video", "truth_index", "prediction_index", F.round("iou", 9).alias("iou"))


@query(f"WITH RECURSIVE {v.MATCHING} SELECT video, i::INT AS truth_index, j::INT AS prediction_index FROM matched")
def ordered_matching(spark, d):
    return iv.matched(v.truths(spark, d), v.predictions(spark, d))


def _details(spark, d):
    return ev.details(v.truths(spark, d), v.predictions(spark, d))


@query(f"""WITH RECURSIVE {v.DETAILS} SELECT video, i::INT AS truth_index, j::INT AS prediction_index, status, status = 'detected' AS detected,
  ts AS truth_start, te AS truth_end, ps AS prediction_start, pe AS prediction_end, ps - ts AS start_error, pe - te AS end_error, round(iou, 9) AS temporal_iou FROM details""")
def segment_details(spark, d):
    return _details(spark, d).drop("split").withColumn("temporal_iou", F.round("temporal_iou", 9))


_MEANS = ("mean_iou_all", "mean_iou_detected", "start_mae", "end_mae", "gap_duration", "gap_false_positive")
_RATES = ("segment_precision", "segment_recall", "segment_f1", "gap_preservation")


def _rounded(frame: DataFrame) -> DataFrame:
    for c in _RATES:
        frame = frame.withColumn(c, F.round(c, 9))
    for c in _MEANS:
        frame = frame.withColumn(c, F.round(c, 6))
    return frame.drop("split")


def _by_series(spark, d, **options) -> DataFrame:
    """Figures of every series, with or without truths and predictions."""
    truths, predictions = v.truths(spark, d), v.predictions(spark, d)
    return ev.by_series(ev.details(truths, predictions), keys=v.frames(spark, d), **options)


_MEANS_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in _MEANS)


@query(f"""WITH RECURSIVE {v.BY_SERIES} SELECT video, truth_segments, predicted_segments, detected_segments, {_MEANS_SQL}, {v.RATES},
  detected_segments = truth_segments AS all_detected, detected_segments = truth_segments AND predicted_segments = detected_segments AS exact_detection FROM series""")
def segment_metrics_by_video(spark, d):
    return _rounded(_by_series(spark, d))


@query(f"""WITH RECURSIVE {v.BY_SERIES},
total AS (
  SELECT (SELECT count(i) FROM details) AS truth_segments, (SELECT count(j) FROM details) AS predicted_segments,
    (SELECT count(*) FROM details WHERE status = 'detected') AS detected_segments, (SELECT avg(iou) FROM details WHERE i IS NOT NULL) AS mean_iou_all,
    (SELECT avg(iou) FROM details WHERE status = 'detected') AS mean_iou_detected, (SELECT avg(abs(ps - ts)) FROM details WHERE status = 'detected') AS start_mae,
    (SELECT avg(abs(pe - te)) FROM details WHERE status = 'detected') AS end_mae, count(*) AS n_series, sum(gap_duration) AS gap_duration,
    sum(gap_false_positive) AS gap_false_positive, count(*) FILTER (detected_segments = truth_segments) AS series_all_detected,
    count(*) FILTER (detected_segments = truth_segments AND predicted_segments = detected_segments) AS series_exact_detection FROM series)
SELECT truth_segments, predicted_segments, detected_segments, {_MEANS_SQL}, n_series, series_all_detected, series_exact_detection, {v.RATES} FROM total""")
def segment_metrics(spark, d):
    return _rounded(ev.overall(_by_series(spark, d, sums=True)))


# Calibration.

_METRICS = """coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall"""
_F1 = "coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1"
_COUNTS = """count(*) FILTER (p AND label = 1) AS tp, count(*) FILTER (p AND label <> 1) AS fp,
  count(*) FILTER (NOT p AND label <> 1) AS tn, count(*) FILTER (NOT p AND label = 1) AS fn"""
_GRID = "grid AS (SELECT k / 100 AS threshold FROM range(5, 96) r(k))"
_BEST = "f1 DESC, recall DESC, precision DESC, abs(threshold - 0.5), threshold"


def _sweep_sql(source: str, by: str = "") -> str:
    return f"""swept_a AS (SELECT {by} threshold, {_COUNTS} FROM (SELECT {by} label, threshold, value >= threshold AS p FROM {source}, grid) GROUP BY {by} threshold),
swept_b AS (SELECT *, {_METRICS} FROM swept_a), swept AS (SELECT *, {_F1} FROM swept_b)"""


_SCORED = f"{v.FRAMES}, {_GRID}, valued AS (SELECT label, score AS value FROM frames)"


@query(f"WITH {v.FRAMES}, c AS (SELECT split, {_COUNTS} FROM (SELECT *, score >= 0.5 AS p FROM frames) GROUP BY split), m AS (SELECT *, {_METRICS} FROM c) SELECT *, {_F1} FROM m")
def confusion_metrics(spark, d):
    return cal.confusion(v.frames(spark, d), F.col("score") >= 0.5, by=("split",))


@query(f"WITH {_SCORED}, {_sweep_sql('valued')} SELECT * FROM swept")
def threshold_sweep(spark, d):
    return cal.sweep(v.frames(spark, d), cal.threshold_grid())


@query(f"WITH {_SCORED}, {_sweep_sql('valued')} SELECT * FROM swept ORDER BY {_BEST} LIMIT 1")
def threshold_best(spark, d):
    return cal.best_threshold(cal.sweep(v.frames(spark, d), cal.threshold_grid()))


_WINDOWS = " UNION ALL ".join(f'SELECT {w} AS "window", label, {v.smooth_sql(w)} AS value FROM frames' for w in (1, 3, 5, 7))


@query(f"""WITH {v.FRAMES}, {_GRID}, valued AS ({_WINDOWS}), {_sweep_sql("valued", '"window",')}
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY "window" ORDER BY {_BEST}) AS k FROM swept) WHERE k = 1""")
def window_threshold_grid(spark, d):
    return cal.window_grid(v.frames(spark, d))


@query(f"""WITH {v.FRAMES}, {_GRID}, valued AS ({_WINDOWS}), {_sweep_sql("valued", '"window",')}
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, recall DESC, precision DESC, abs(threshold - 0.5), "window") AS k FROM swept) WHERE k = 1""")
def best_smoothing_window(spark, d):
    return cal.best_window(cal.window_grid(v.frames(spark, d)))


@query(f"WITH {v.FRAMES}, c AS (SELECT label, count(*) AS n FROM frames GROUP BY label) SELECT label, n, (SELECT sum(n) FROM c)::BIGINT / (2 * n) AS weight FROM c")
def class_weights(spark, d):
    return cal.class_weights(v.frames(spark, d))


@query(f"WITH {v.FRAMES} SELECT split, round(sum(score * label) / sum(score), 9) AS mean FROM frames GROUP BY split")
def weighted_mean_loss(spark, d):
    return cal.weighted_mean(v.frames(spark, d), "label", "score", by=("split",)).withColumn("mean", F.round("mean", 9))


# Data sets.


@query(f"""WITH {v.FRAMES}, n AS (SELECT *, row_number() OVER (ORDER BY md5(video || '|' || event_id || '|42')) AS k FROM frames WHERE label <> 1)
SELECT event_id, label FROM frames WHERE label = 1 UNION ALL
SELECT event_id, label FROM n WHERE k <= 2 * (SELECT count(*) FROM frames WHERE label = 1)""")
def negative_downsample(spark, d):
    return ds.downsampled(v.frames(spark, d), 2, key=("video", "event_id")).select("event_id", "label")


@query(f"""WITH {v.FRAMES}, i AS (SELECT DISTINCT video FROM frames),
n AS (SELECT video, row_number() OVER (ORDER BY md5(video || '|42')) AS k, greatest(1, round_even((SELECT count(*) FROM i) * 0.15::DOUBLE, 0)) AS m FROM i)
SELECT video, CASE WHEN k <= m THEN 'test' WHEN k <= 2 * m THEN 'val' ELSE 'train' END AS split FROM n""")
def split_assign(spark, d):
    return ds.hashed_split(v.frames(spark, d))


@query("""SELECT o_custkey AS video, count(DISTINCT o_orderstatus) AS splits FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1""")
def split_leak_check(spark, d):
    return ds.split_leaks(read(spark, d, "orders").select(F.col("o_custkey").alias("video"), F.col("o_orderstatus").alias("split")))


@query("SELECT l_orderkey, l_linenumber, count(*) - 1 AS extra FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return ds.repeated_keys(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(f"WITH {v.FRAMES} SELECT event_id, split FROM frames WHERE split = 'val' UNION ALL SELECT event_id, split FROM frames WHERE split = 'test'")
def union_splits(spark, d):
    f = v.frames(spark, d).select("event_id", "split")
    return ev.of_split(f, "val").unionByName(ev.of_split(f, "test"))


@query("""(SELECT 'left_only' AS part, o_custkey AS id FROM orders EXCEPT SELECT 'left_only', user_id FROM events)
UNION ALL (SELECT 'both', o_custkey FROM orders INTERSECT SELECT 'both', user_id FROM events)
UNION ALL (SELECT 'either', o_custkey FROM orders UNION SELECT 'either', user_id FROM events)""")
def set_checks(spark, d):
    a, b = read(spark, d, "orders").select(F.col("o_custkey").alias("id")), read(spark, d, "events").select(F.col("user_id").alias("id"))
    parts = {"left_only": a.subtract(b), "both": a.intersect(b), "either": a.union(b).distinct()}
    out = [f.select(F.lit(n).alias("part"), "id") for n, f in parts.items()]
    return out[0].union(out[1]).union(out[2])


# Text and time.

_TEXTS = """texts AS (SELECT event_id, event_id % 90 AS m, (event_id * 7) % 75 AS s, event_id % 5 AS h, CASE event_id % 4
  WHEN 0 THEN ((event_id * 7) % 75)::VARCHAR || '.5' WHEN 1 THEN (event_id % 90) || ':' || lpad(((event_id * 7) % 75)::VARCHAR, 2, '0')
  WHEN 2 THEN (event_id % 5) || ':' || lpad((event_id % 90)::VARCHAR, 2, '0') || ':' || lpad(((event_id * 7) % 75)::VARCHAR, 2, '0') ELSE 'x' || event_id END AS text FROM events)"""


def _texts(spark, d):
    e = F.col("event_id")
    m, s, h = e % 90, (e * 7) % 75, e % 5
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    text = (
        F.when(e % 4 == 0, F.concat(s.cast("string"), F.lit(".5"))).when(e % 4 == 1, F.concat_ws(":", m.cast("string"), two(s)))
        .when(e % 4 == 2, F.concat_ws(":", h.cast("string"), two(m), two(s))).otherwise(F.concat(F.lit("x"), e.cast("string")))
    )
    return read(spark, d, "events").select("event_id", text.alias("text"))


@query(f"""WITH {_TEXTS} SELECT event_id, CASE event_id % 4 WHEN 0 THEN s + 0.5::DOUBLE WHEN 1 THEN (CASE WHEN m < 60 AND s < 60 THEN m * 60 + s END)::DOUBLE
  WHEN 2 THEN (CASE WHEN m < 60 AND s < 60 THEN h * 3600 + m * 60 + s END)::DOUBLE END AS strict,
  CASE event_id % 4 WHEN 0 THEN s + 0.5::DOUBLE WHEN 1 THEN (m * 60 + s)::DOUBLE WHEN 2 THEN (h * 3600 + m * 60 + s)::DOUBLE END AS lenient FROM texts""")
def timestamp_parse(spark, d):
    text = F.col("text")
    return _texts(spark, d).select("event_id", tt.seconds_of(text).alias("strict"), tt.seconds_of(text, strict=False).alias("lenient"))


@query("""WITH r AS (SELECT event_id, event_id % 50 AS m, (event_id * 11) % 70 AS s, event_id % 40 AS n FROM events)
SELECT event_id, CASE WHEN s < 60 AND (m + 1) * 60 + n > m * 60 + s THEN (m * 60 + s)::DOUBLE END AS start_seconds,
  CASE WHEN s < 60 AND (m + 1) * 60 + n > m * 60 + s THEN ((m + 1) * 60 + n)::DOUBLE END AS end_seconds FROM r""")
def range_parse(spark, d):
    e = F.col("event_id")
    text = F.format_string("%d.%02d - 00:%02d:%02d", e % 50, (e * 11) % 70, e % 50 + 1, e % 40)
    x = read(spark, d, "events").select("event_id", tt.range_of(text).alias("x"))
    return x.select("event_id", F.col("x.start").alias("start_seconds"), F.col("x.end").alias("end_seconds"))


_CLOCK = """WITH ms AS (SELECT event_id, event_id * 9973 % 400000000 AS ms FROM events),
p AS (SELECT event_id, ms % 1000 AS z, lpad((ms // 3600000)::VARCHAR, greatest(2, len((ms // 3600000)::VARCHAR))::INT, '0') AS h, lpad((ms // 60000 % 60)::VARCHAR, 2, '0') AS m, lpad((ms // 1000 % 60)::VARCHAR, 2, '0') AS s FROM ms)
SELECT event_id, h || ':' || m || ':' || s || CASE WHEN z > 0 THEN '.' || rtrim(lpad(z::VARCHAR, 3, '0'), '0') ELSE '' END AS clock,
  h || '-' || m || '-' || s || CASE WHEN z > 0 THEN '-' || lpad(z::VARCHAR, 3, '0') ELSE '' END AS tag FROM p"""


@query(_CLOCK)
def timestamp_format(spark, d):
    x = read(spark, d, "events").select("event_id", (F.col("event_id") * 9973 % 400000000 / 1000).alias("t"))
    return x.select("event_id", tt.clock_of(F.col("t")).alias("clock"), tt.tag_of(F.col("t")).alias("tag"))


@query("""SELECT event_id, 'frame_' || lpad(event_id::VARCHAR, 6, '0') || '.jpg' AS name,
  'frame_' || lpad(event_id::VARCHAR, 6, '0') || '_t' || lpad((event_id * 31)::VARCHAR, 10, '0') || '.jpg' AS timed FROM events""")
def frame_names(spark, d):
    # The SQL's lpad cuts numbers that are too long; fixed does the same.
    e = F.col("event_id")
    return read(spark, d, "events").select("event_id", tt.frame_name(e, fixed=True).alias("name"), tt.frame_name(e, e * 31, fixed=True).alias("timed"))


@query("""SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), ''), 'video') AS stem,
  regexp_extract(url, '([^/]*)$', 1) AS name, regexp_extract(url, '([^/]*)/[^/]*$', 1) AS parent FROM pages""")
def safe_name(spark, d):
    url = F.col("url")
    return read(spark, d, "pages").select("page_id", tx.safe_stem(url, fold=False).alias("stem"), tx.path_name(url).alias("name"), tx.parent_name(url).alias("parent"))


@query(f"""WITH {v.PREDICTIONS}, n AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY "start", "end") AS number, round("start" * 1000)::BIGINT AS a, round("end" * 1000)::BIGINT AS b FROM predictions),
g AS (SELECT *, lpad((a // 3600000)::VARCHAR, greatest(2, len((a // 3600000)::VARCHAR))::INT, '0') || '-' || lpad((a // 60000 % 60)::VARCHAR, 2, '0') || '-' || lpad((a // 1000 % 60)::VARCHAR, 2, '0') || CASE WHEN a % 1000 > 0 THEN '-' || lpad((a % 1000)::VARCHAR, 3, '0') ELSE '' END AS ta,
  lpad((b // 3600000)::VARCHAR, greatest(2, len((b // 3600000)::VARCHAR))::INT, '0') || '-' || lpad((b // 60000 % 60)::VARCHAR, 2, '0') || '-' || lpad((b // 1000 % 60)::VARCHAR, 2, '0') || CASE WHEN b % 1000 > 0 THEN '-' || lpad((b % 1000)::VARCHAR, 3, '0') ELSE '' END AS tb FROM n)
SELECT video, number::INT AS number, "end" - "start" AS duration, 'clips/' || video || '_lineup_' || lpad(number::VARCHAR, 2, '0') || '_' || ta || '_to_' || tb || '.mp4' AS output FROM g""")
def clip_jobs(spark, d):
    return sinks.clip_jobs(v.predictions(spark, d), "clips/", fold=False).select("video", "number", "duration", "output")


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS norm FROM part")
def normalize_ascii(spark, d):
    return read(spark, d, "part").select("p_partkey", tx.normalized_ascii(F.col("p_name")).alias("norm"))


@query()
def normalize_unicode(spark, d):
    return read(spark, d, "documents").select("doc_id", tx.normalized("text").alias("norm"))


@query()
def text_similarity(spark, d):
    a = read(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return a.select("p_partkey", tx.similarity("p_name", "p_type").alias("similarity"))


@query("""SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 99 THEN 'shirt_number_candidate' ELSE 'text' END AS size_type, 'text' AS name_type,
  (p_size BETWEEN 1 AND 99) AS is_number FROM part""")
def classify_text(spark, d):
    size = F.col("p_size").cast("string")
    kind = tx.text_type(size)
    return read(spark, d, "part").select("p_partkey", kind.alias("size_type"), tx.text_type(F.col("p_name")).alias("name_type"), tx.is_shirt_number(kind, size).alias("is_number"))


@query(f"WITH {v.DETECTIONS} SELECT video, frame_index, row_id, text FROM detections WHERE text_type = 'shirt_number_candidate' AND text::INT BETWEEN 1 AND 99")
def shirt_number_filter(spark, d):
    return det.numbers_of(v.detections(spark, d)).select("video", "frame_index", "row_id", "text")


@query("""WITH t AS (SELECT p_partkey, p_partkey % 120 AS n, p_name FROM part)
SELECT p_partkey, CASE WHEN n BETWEEN 1 AND 99 THEN n::INT END AS number, CASE WHEN n BETWEEN 1 AND 99 THEN p_name END AS name FROM t
WHERE len(regexp_replace(lower(p_name), '[^a-z]', '', 'g')) >= 2 AND len(p_name) <= 40""")
def inline_player(spark, d):
    text = F.concat_ws("  ", (F.col("p_partkey") % 120).cast("string"), F.col("p_name"))
    x = read(spark, d, "part").filter(tx.is_name(tx.normalized_ascii(F.col("p_name")))).select("p_partkey", tx.inline_player(text).alias("x"))
    return x.select("p_partkey", F.col("x.number").alias("number"), F.col("x.name").alias("name"))


# Detections.



def _near_sql(left: str, right: str, band: str, cost: str) -> str:
    return f"""WITH {v.DETECTIONS}, a AS (SELECT * FROM detections WHERE {left}), b AS (SELECT * FROM detections WHERE {right}),
p AS (SELECT a.video, a.frame_index, a.row_id AS n_row_id, b.row_id AS o_row_id, {cost} AS cost FROM a JOIN b ON a.video = b.video AND a.frame_index = b.frame_index WHERE {band}),
k AS (SELECT *, row_number() OVER (PARTITION BY video, frame_index, n_row_id ORDER BY cost, o_row_id) AS k FROM p)
SELECT video, frame_index, n_row_id, o_row_id, round(cost, 9) AS cost FROM k WHERE k = 1"""


_NUM, _NAM = "text_type = 'shirt_number_candidate' AND text::INT BETWEEN 1 AND 99", "text_type = 'text'"
_NEAR = ["video", "frame_index", "n_row_id", "o_row_id"]


@query(_near_sql(_NAM, _NUM, "a.x - b.x BETWEEN 0.015::DOUBLE AND 0.25::DOUBLE AND abs(a.y - b.y) <= 0.022::DOUBLE", "5 * abs(a.y - b.y) + (a.x - b.x)"))
def nearest_band_join(spark, d):
    rows = v.detections(spark, d)
    return det.numbers_left_of_names(det.names_of(rows), det.numbers_of(rows)).select(*_NEAR, F.round("cost", 9).alias("cost"))


@query(_near_sql(_NUM, _NAM, "abs(b.x - a.x) <= 0.07::DOUBLE AND b.y - a.y BETWEEN 0.03::DOUBLE AND 0.13::DOUBLE", "abs(b.x - a.x) + abs(b.y - a.y - 0.078::DOUBLE)"))
def label_under_number(spark, d):
    rows = v.detections(spark, d)
    return det.labels_under_numbers(det.numbers_of(rows), det.names_of(rows)).select(*_NEAR, F.round("cost", 9).alias("cost"))


@query(f"""WITH {v.DETECTIONS}, s AS (SELECT * FROM detections WHERE text_type = 'text'),
two AS (SELECT a.video, a.frame_index, 2 AS n, list_sort([(a.y, a.row_id, a.score), (b.y, b.row_id, b.score)]) AS l FROM s a JOIN s b
  ON a.video = b.video AND a.frame_index = b.frame_index AND a.row_id < b.row_id WHERE abs(a.x - b.x) <= 0.065::DOUBLE AND abs(a.y - b.y) <= 0.09::DOUBLE),
three AS (SELECT a.video, a.frame_index, 3 AS n, list_sort([(a.y, a.row_id, a.score), (b.y, b.row_id, b.score), (c.y, c.row_id, c.score)]) AS l FROM s a
  JOIN s b ON a.video = b.video AND a.frame_index = b.frame_index AND a.row_id < b.row_id JOIN s c ON c.video = b.video AND c.frame_index = b.frame_index AND b.row_id < c.row_id
  WHERE greatest(a.x, b.x, c.x) - least(a.x, b.x, c.x) <= 0.065::DOUBLE AND greatest(a.y, b.y, c.y) - least(a.y, b.y, c.y) <= 0.14::DOUBLE),
both_ AS (SELECT * FROM two UNION ALL SELECT * FROM three WHERE l[2][1] - l[1][1] <= 0.09::DOUBLE AND l[3][1] - l[2][1] <= 0.09::DOUBLE)
SELECT video, frame_index, n, array_to_string(list_transform(l, lambda r: r[2]), ',') AS row_ids, round(list_sum(list_transform(l, lambda r: r[3])) / n, 9) AS score FROM both_""")
def stack_pairs(spark, d):
    return det.vertical_stacks(det.names_of(v.detections(spark, d))).select("video", "frame_index", "n", "row_ids", F.round("score", 9).alias("score"))


def _cells(spark, d):
    cell = F.concat_ws("-", "video", F.floor(F.col("x") * 10).cast("string"), F.floor(F.col("y") * 10).cast("string"))
    return det.numbers_of(v.detections(spark, d)).withColumn("cluster", cell)


_CELLS = f"""{v.DETECTIONS}, cells AS (SELECT *, video || '-' || floor(x * 10)::INT || '-' || floor(y * 10)::INT AS cluster FROM detections WHERE {_NUM}),
votes AS (SELECT cluster, text, count(DISTINCT frame_index) AS frames, sum(score) AS total, avg(score) AS confidence, min(row_id) AS first FROM cells GROUP BY cluster, text)"""


@query(f"""WITH {_CELLS} SELECT cluster, text, frames, round(total, 6) AS total, round(confidence, 9) AS confidence
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY frames DESC, round(total, 9) DESC, first) AS k FROM votes) WHERE k = 1""")
def number_vote(spark, d):
    return det.number_votes(_cells(spark, d)).select("cluster", "text", "frames", F.round("total", 6).alias("total"), F.round("confidence", 9).alias("confidence"))


@query(f"""WITH {v.DETECTIONS}, j AS (SELECT *, coalesce(y - lag(y) OVER o > 0.09, true) AS fresh FROM detections WHERE {_NUM} WINDOW o AS (PARTITION BY video, frame_index ORDER BY y, x, row_id))
SELECT video, frame_index, row_id, sum(fresh::INT) OVER (PARTITION BY video, frame_index ORDER BY y, x, row_id)::BIGINT AS row_index FROM j""")
def visual_rows(spark, d):
    found = det.visual_rows(det.numbers_of(v.detections(spark, d)), ("video", "frame_index"))
    return found.select("video", "frame_index", "row_id", F.col("row_index").cast("long").alias("row_index"))


@query(f"""WITH {v.DETECTIONS} SELECT video, text, row_id, score FROM (SELECT *, row_number() OVER (PARTITION BY video, text ORDER BY score DESC, row_id) AS k FROM detections) WHERE k = 1""")
def dedup_best_score(spark, d):
    return det.best_of_each(v.detections(spark, d), ["video", "text"]).select("video", "text", "row_id", "score")


@query(f"""WITH {v.DETECTIONS}, cells AS (SELECT video, video || '-' || floor(x * 10)::INT || '-' || floor(y * 10)::INT AS cluster,
  count(DISTINCT frame_index) FILTER (text_type = 'text') AS label_frames, count(DISTINCT frame_index) FILTER ({_NUM}) AS frames,
  coalesce(sum(score) FILTER ({_NUM}), 0) AS total, median(x) AS x, median(y) AS y FROM (SELECT * REPLACE (CASE WHEN text_type = 'text' THEN '0' ELSE text END AS text) FROM detections) GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY (label_frames > 0)::INT DESC, label_frames DESC, frames DESC, round(total, 9) DESC, cluster) AS k FROM cells)
SELECT video, cluster, row_number() OVER (PARTITION BY video ORDER BY y, x, cluster)::INT AS slot FROM c WHERE k <= 11""")
def topk_clusters(spark, d):
    rows = v.detections(spark, d)
    cell = F.concat_ws("-", "video", F.floor(F.col("x") * 10).cast("string"), F.floor(F.col("y") * 10).cast("string"))
    cells = det.cluster_figures(rows.withColumn("cluster", cell))
    return det.top_clusters(cells).select("video", "cluster", "slot")


_HEAD = "(norm LIKE '%00' AND norm LIKE 'part%')"


def _headed(spark, d):
    """Detections whose names that end in 00 stand for a header of substitutes."""
    head = F.col("norm").like("%00") & F.col("norm").like("part%")
    return v.detections(spark, d).withColumn("norm", F.when(head, F.lit("the substitutes")).otherwise(F.col("norm")))


@query(f"""WITH {v.DETECTIONS}, c AS (SELECT *, row_id % 1000 AS pos, min(CASE WHEN {_HEAD} THEN row_id END) OVER (PARTITION BY video, frame_index) AS cut FROM normed)
SELECT video, frame_index, row_id FROM c WHERE cut IS NULL OR row_id < cut""")
def cut_before(spark, d):
    return det.before_substitutes(_headed(spark, d), by=("video", "frame_index"), time="row_id").select("video", "frame_index", "row_id")


@query(f"""WITH {v.DETECTIONS}, c AS (SELECT *, median(CASE WHEN {_HEAD} THEN x END) OVER (PARTITION BY video, frame_index) AS hx FROM normed)
SELECT video, frame_index, row_id FROM c WHERE NOT coalesce(CASE WHEN hx < 0.5 THEN x < hx + 0.15::DOUBLE ELSE x > hx - 0.15::DOUBLE END, false)""")
def panel_filter(spark, d):
    return det.without_panel(_headed(spark, d)).select("video", "frame_index", "row_id")


@query(f"WITH {v.DETECTIONS} SELECT video, frame_index, row_id FROM detections WHERE NOT (score BETWEEN 0 AND 1 AND x BETWEEN 0 AND 1 AND y BETWEEN 0 AND 1)")
def detection_faults(spark, d):
    return det.faults(v.detections(spark, d)).select("video", "frame_index", "row_id")


def _arrays(spark, d):
    """Detections of each order as parallel arrays, as a recogniser returns them."""
    rows = v.detections(spark, d)
    box = F.array(*(c.cast("int") for c in (F.col("x") * 1000, F.col("y") * 1000, F.col("x") * 1000 + 40, F.col("y") * 1000 + 20)))
    item = F.struct("row_id", "text", "score", box.alias("box"))
    held = rows.groupBy("video", "frame_index").agg(F.sort_array(F.collect_list(item)).alias("l"))
    return held.select("video", "frame_index", F.lit(1280).alias("frame_width"), F.lit(720).alias("frame_height"), F.transform("l", lambda r: r["text"]).alias("texts"), F.transform("l", lambda r: r["score"]).alias("scores"), F.transform("l", lambda r: r["box"]).alias("boxes"), "l")


@query(f"""WITH {v.DETECTIONS}, z AS (SELECT *, (row_number() OVER (PARTITION BY video, frame_index ORDER BY row_id) - 1)::INT AS detection_index, trunc(x * 1000)::INT AS x1, trunc(x * 1000 + 40)::INT AS x2 FROM detections)
SELECT video, frame_index, detection_index, text, text_type, round(score, 6) AS score, x1, x2, (x1 + x2) / 2 AS center_x FROM (SELECT * REPLACE (CASE WHEN text_type = 'text' OR text::INT NOT BETWEEN 1 AND 99 THEN 'text' ELSE text_type END AS text_type) FROM z) WHERE round(score, 6) >= 0.95::DOUBLE""")
def zip_detections(spark, d):
    return det.unnested(_arrays(spark, d).drop("l"), 0.95).select("video", "frame_index", "detection_index", "text", "text_type", "score", "x1", "x2", "center_x")


@query(f"""WITH {v.DETECTIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY video, frame_index ORDER BY score DESC, row_id) AS k FROM detections WHERE {_NUM} AND score >= 0.6)
SELECT video, frame_index, text, score FROM k WHERE k = 1""")
def best_numeric_element(spark, d):
    pairs = F.transform("l", lambda r: F.struct(r["text"].alias("text"), r["score"].alias("score")))
    best = _arrays(spark, d).select("video", "frame_index", det.best_number(pairs).alias("b")).filter("b is not null")
    return best.select("video", "frame_index", F.col("b.text").alias("text"), F.col("b.score").alias("score"))


@query(f"""WITH {v.DETECTIONS} SELECT video, frame_index, count(*)::INT AS n, sum(len(text))::BIGINT AS letters, round(max(score), 9) AS best FROM detections GROUP BY video, frame_index""")
def json_results(spark, d):
    """Results of a recogniser as JSON, with and without an envelope, read back."""
    rows = _arrays(spark, d)
    inner = F.struct("texts", "scores")
    wrapped = F.when(F.col("frame_index") % 2 == 0, F.to_json(F.struct(inner.alias("res")))).otherwise(F.to_json(inner))
    back = rows.select("video", "frame_index", tables.unwrapped(wrapped, "texts array<string>, scores array<double>").alias("r"))
    letters = F.aggregate("r.texts", F.lit(0).cast("long"), lambda n, t: n + F.length(t))
    return back.select("video", "frame_index", F.size("r.texts").alias("n"), letters.alias("letters"), F.round(F.array_max("r.scores"), 9).alias("best"))


# Scoring.

_WEIGHTS = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]
_W = "[" + ", ".join(f"{w}::DOUBLE" for w in _WEIGHTS) + "]"


@query(f"SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], {_W}), 9) AS logit FROM embeddings")
def linear_scorer(spark, d):
    return read(spark, d, "embeddings").select("vec_id", F.round(sc.linear_score(F.col("embedding"), _WEIGHTS), 9).alias("logit"))


@query(f"SELECT vec_id, round(1 / (1 + exp(-list_dot_product(embedding::DOUBLE[], {_W}))), 9) AS score FROM embeddings")
def softmax_positive(spark, d):
    logit = sc.linear_score(F.col("embedding"), _WEIGHTS)
    return read(spark, d, "embeddings").select("vec_id", F.round(sc.positive_share(F.lit(0.0), logit), 9).alias("score"))


@query(f"WITH {v.SMOOTHED} SELECT event_id, (score >= 0.4)::INT AS raw_pred_label, (smoothed >= 0.5)::INT AS pred_label FROM smoothed")
def threshold_decisions(spark, d):
    f = sg.smoothed(v.frames(spark, d), 5, name="smoothed_score")
    return sc.decided(f, 0.5, 0.4).select("event_id", "raw_pred_label", "pred_label")


@query()
def classifier_epochs(spark, d):
    """The epochs of a classifier of embeddings, label 0 against the others, in two stages."""
    rows = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"), (F.col("label") == 0).cast("int").alias("label"))
    held = F.col("id") % 5 == 0
    found = tr.train(rows.filter(~held), rows.filter(held), [tr.Stage(3, 0.05, tuple(range(32))), tr.Stage(4, 0.05)], patience=2, augment=True)
    kind = "stage int, epoch int, threshold double, f1 double, recall double, precision double"
    return spark.createDataFrame([tuple(e.values()) for e in found.epochs], kind)


@query(f"""WITH {v.FRAMES}, ids AS (SELECT DISTINCT video FROM frames) SELECT event_id, CASE WHEN video IN (SELECT video FROM ids ORDER BY video::VARCHAR LIMIT 3) THEN 'test'
  WHEN video IN (SELECT video FROM ids ORDER BY video::VARCHAR LIMIT 5) THEN 'val' ELSE 'train' END AS split FROM frames""")
def split_of_map(spark, d):
    """Rows joined with a split by explicit ids."""
    frames = v.frames(spark, d).withColumn("key", F.col("video").cast("string"))
    ids = sorted(r[0] for r in frames.select("key").distinct().collect())
    splits = ds.drawn_split(ids, test_ids=tuple(ids[:3]), val_ids=tuple(ids[3:5]))
    return ds.with_split(frames.drop("split"), splits, "key").select("event_id", "split")


# Resolvers: order decides, so no SQL; unit tests state their rows.


def _segments(spark, d) -> DataFrame:
    """Detections in segments of forty frames, two frames a second."""
    rows = v.detections(spark, d)
    frame = F.col("frame_index")
    return rows.withColumn("segment_index", F.floor(frame / 40).cast("int")).withColumn("timestamp_seconds", frame % 40 / 2).withColumn("segment_end_seconds", F.lit(20.0))


_OPTIONS = rs.Options(players=3, least_numbers=2, same_gap=5.0)


@query(f"""WITH {v.LINEUPS} SELECT video, k::INT AS segment_index, late::INT + 1 AS lineup_index, CASE WHEN tab THEN 'table' ELSE 'formation' END AS resolution_method,
  (late * 61.5)::DOUBLE AS formation_timestamp_seconds, row_number() OVER (PARTITION BY k, late ORDER BY CASE WHEN tab THEN i ELSE pitch_row END, pitch_x)::INT AS slot_index,
  (CASE WHEN tab THEN i ELSE pitch_row END + 1)::INT AS row_index, number::INT AS shirt_number, n_name AS formation_label, n_name AS player_name,
  round(number_score, 6) AS number_confidence, round(label_score, 6) AS label_confidence,
  round(CASE WHEN tab THEN label_score ELSE any_score END, 6) AS name_confidence,
  round(CASE WHEN tab THEN pair_score ELSE (number_score * label_score * any_score) ** (1 / 3) END, 6) AS pair_confidence,
  seen::INT AS number_evidence_frames, label_frames::INT AS label_evidence_frames, label_frames::INT AS full_name_evidence_frames,
  round(CASE WHEN tab THEN 0.2 ELSE pitch_x END, 6)::DOUBLE AS slot_center_x_norm, round(CASE WHEN tab THEN 0.1 + 0.07 * i ELSE 0.1 + 0.2 * pitch_row END, 6)::DOUBLE AS slot_center_y_norm
FROM found""")
def lineup_records(spark, d):
    """All columns of resolved lineups, of segments whose lineups are known by rule."""
    return rs.resolved(v.lineups(spark, d), rs.Options())


@query("""SELECT 'v' || s_nationkey AS video, s_suppkey::INT AS segment_index, CASE WHEN k IN (2, 3) THEN 'unresolved' ELSE 'resolved' END AS status,
  CASE k WHEN 0 THEN 'table' WHEN 1 THEN 'formation' WHEN 4 THEN 'formation' ELSE '' END AS resolution_method, CASE k WHEN 0 THEN 11 WHEN 1 THEN 11 WHEN 4 THEN 22 ELSE 0 END::INT AS resolved_players,
  CASE k WHEN 0 THEN 'Complete repeated table/list consensus.' WHEN 2 THEN 'table/list pass found 10/11 players; Only 10 player slots found for lineup 1; expected 11.' WHEN 3 THEN 'Only 10 player slots found for lineup 1; expected 11.' ELSE '' END AS message
FROM (SELECT *, s_suppkey % 5 AS k FROM supplier)""")
def lineup_diagnostics(spark, d):
    return rs.resolved(v.lineups(spark, d), rs.Options(), diagnose=True)


@query()
def events_by_gap_signature(spark, d):
    def step(rows, end):
        found = rs.events(rows, _OPTIONS)
        return [{"event": i, "start_seconds": min(e.times), "end_seconds": max(e.times), "n": len(e.frames)} for i, e in enumerate(found, start=1)]

    return rs.per_segment(_segments(spark, d), step, "event int, start_seconds double, end_seconds double, n int")


_MIDDLE = "list_aggregate({}, 'median')"


@query(f"""WITH RECURSIVE {v.DETECTIONS},
seg AS (SELECT video, (frame_index // 40)::INT AS segment_index, list({{'x': x, 'y': y}} ORDER BY frame_index, y, x, row_id) AS p FROM detections WHERE {_NUM} GROUP BY ALL),
walk AS (
  SELECT video, segment_index, p, 0 AS k, []::STRUCT(xs DOUBLE[], ys DOUBLE[])[] AS c FROM seg
  UNION ALL
  SELECT video, segment_index, p, k + 1, CASE WHEN b IS NULL THEN list_append(c, {{'xs': [q.x], 'ys': [q.y]}})
    ELSE list_transform(c, lambda e, i: CASE WHEN i = b.i THEN {{'xs': list_append(e.xs, q.x), 'ys': list_append(e.ys, q.y)}} ELSE e END) END
  FROM (SELECT *, list_sort(list_filter(list_transform(c, lambda e, i: {{'cost': abs(q.x - {_MIDDLE.format("e.xs")}) + abs(q.y - {_MIDDLE.format("e.ys")}), 'i': i,
    'near': abs(q.x - {_MIDDLE.format("e.xs")}) <= 0.045::DOUBLE AND abs(q.y - {_MIDDLE.format("e.ys")}) <= 0.065::DOUBLE}}), lambda z: z.near))[1] AS b
    FROM (SELECT *, p[k + 1] AS q FROM walk WHERE k < len(p)))),
each AS (SELECT video, segment_index, unnest(range(1, len(c) + 1)) AS i, c FROM walk WHERE k = len(p))
SELECT video, segment_index, i::INT AS cluster, round({_MIDDLE.format("c[i].xs")}, 9) AS x, round({_MIDDLE.format("c[i].ys")}, 9) AS y, len(c[i].xs)::INT AS n FROM each""")
def leader_clusters(spark, d):
    def step(rows, end):
        return [{"cluster": i, "x": c.x, "y": c.y, "n": len(c.rows)} for i, c in enumerate(rs.clusters(rows), start=1)]

    found = rs.per_segment(_segments(spark, d), step, "cluster int, x double, y double, n int")
    return found.withColumn("x", F.round("x", 9)).withColumn("y", F.round("y", 9))


@query()
def fuzzy_consensus(spark, d):
    def step(rows, end):
        votes = [(r.text, r.score, r.frame) for r in rows if r.kind != tx.NUMBER]
        return [dict(zip(("text", "confidence", "frames"), rs.consensus(votes)))]

    return rs.per_segment(_segments(spark, d), step, "text string, confidence double, frames int")


@query(f"""WITH RECURSIVE {v.DETECTIONS},
nums AS (SELECT video, frame_index, list({{'id': row_id, 'x': x, 'y': y}} ORDER BY row_id) AS n FROM normed WHERE {_NUM} GROUP BY ALL),
nams AS (SELECT video, frame_index, list({{'id': row_id, 'x': x, 'y': y}} ORDER BY row_id) AS m FROM normed
  WHERE text_type = 'text' AND len(norm) BETWEEN 1 AND 40 AND len(regexp_replace(norm, '[^a-z]', '', 'g')) >= 2 GROUP BY ALL),
walk AS (
  SELECT video, frame_index, n, m, 0 AS k, []::BIGINT[] AS used, NULL::BIGINT AS number_id, NULL::BIGINT AS name_id FROM nums JOIN nams USING (video, frame_index)
  UNION ALL
  SELECT video, frame_index, n, m, k + 1, CASE WHEN b IS NULL THEN used ELSE list_append(used, b.id) END, c.id, b.id
  FROM (SELECT *, list_sort(list_transform(list_filter(m, lambda r: NOT list_contains(used, r.id) AND abs(r.x - c.x) <= 0.065::DOUBLE AND r.y - c.y BETWEEN 0.025::DOUBLE AND 0.13::DOUBLE),
    lambda r: {{'cost': abs(r.x - c.x) + abs(r.y - c.y - 0.06::DOUBLE), 'id': r.id}}))[1] AS b FROM (SELECT *, n[k + 1] AS c FROM walk WHERE k < len(n))))
SELECT video, frame_index, number_id, name_id FROM walk WHERE name_id IS NOT NULL""")
def greedy_anchors(spark, d):
    rows = _segments(spark, d)
    return rs.per_frame(rows, lambda r: [{"number_id": n.row_id, "name_id": m.row_id} for n, m in rs.anchors(r)], "number_id long, name_id long")


@query()
def table_lineup(spark, d):
    return rs.resolved(_segments(spark, d), _OPTIONS, layout="table")


@query()
def formation_lineup(spark, d):
    return rs.resolved(_segments(spark, d), _OPTIONS, layout="formation")


@query()
def resolve_all(spark, d):
    return rs.resolved(_segments(spark, d), _OPTIONS)


@query()
def resolve_diagnostics(spark, d):
    return rs.resolved(_segments(spark, d), _OPTIONS, diagnose=True)
