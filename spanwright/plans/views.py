"""Views of the shared tables as frames, truths and detections, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.functions.text import NUMBER, normalized_ascii
from spanwright.functions.text import TEXT as TEXT_KIND
from spanwright.operators.segments import islands, segments_of, smoothed
from spanwright.sources.tables import read

GAP, LEAST = 43_200.0, 86_400.0
EPOCH = "2024-01-01 00:00:00"


def frames(spark: SparkSession, d: str) -> DataFrame:
    """Events as scored frames; time is seconds from the epoch of the data."""
    t = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{EPOCH}', ts)") / 1e6
    m = F.col("user_id") % 20
    return read(spark, d, "events").select(
        F.col("user_id").alias("video"), "event_id", "event_type", t.alias("t"), (F.least("value", F.lit(100.0)) / 100).alias("score"),
        (F.col("event_type") == "purchase").cast("int").alias("label"), F.when(m < 3, "test").when(m < 6, "val").otherwise("train").alias("split"),
    )


def truths(spark: SparkSession, d: str) -> DataFrame:
    """The runs of purchases and views of each series."""
    return islands(frames(spark, d), F.col("event_type").isin("purchase", "view"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    scored = smoothed(frames(spark, d), 5).withColumnRenamed("score", "raw").withColumnRenamed("smoothed", "score")
    return segments_of(scored, 0.5, GAP, LEAST)


def detections(spark: SparkSession, d: str) -> DataFrame:
    """Two detections for each line of an order: a number and a name."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    # Row ids rise with the frame and, within it, with the line.
    lines = read(spark, d, "lineitem").withColumn("n", F.col("l_orderkey") * 500 + F.row_number().over(order))
    lines = lines.join(read(spark, d, "part").select("p_partkey", "p_size", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    x, y = 0.8 * (F.col("l_partkey") % 1000).cast("double") / 1000, 0.8 * (F.col("l_suppkey") % 100).cast("double") / 100
    base = lines.select(
        F.concat("l_returnflag", "l_linestatus").alias("video"), F.col("l_orderkey").alias("frame_index"), (1 - F.col("l_discount")).alias("score"), "n", "p_size", "p_name",
        x.alias("bx"), y.alias("by"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"),
    )
    number = base.select("video", "frame_index", (2 * F.col("n")).cast("long").alias("row_id"), F.col("p_size").cast("string").alias("text"), F.lit(NUMBER).alias("text_type"), "score", F.col("bx").alias("x"), F.col("by").alias("y"))
    name = base.select(
        "video", "frame_index", (2 * F.col("n") + 1).cast("long").alias("row_id"), F.col("p_name").alias("text"), F.lit(TEXT_KIND).alias("text_type"), "score",
        (F.col("bx") + 0.01 * F.col("line")).alias("x"), (F.col("by") + 0.012 * (F.col("quantity") % 10)).alias("y"),
    )
    return number.unionByName(name).withColumn("norm", normalized_ascii(F.col("text")))


#: Rows of a pitch: slots 0; 1 to 4; 5 to 7; 8 to 10.
_PITCH_ROW, _PITCH_COLUMN = (0, 1, 1, 1, 1, 2, 2, 2, 3, 3, 3), (1, 0, 1, 2, 3, 0, 1, 2, 0, 1, 2)


def lineups(spark: SparkSession, d: str) -> DataFrame:
    """A segment for each supplier, of eleven nations as players in three frames.

    A player's name is six to nine letters of a digest of the nation's.
    By the supplier's key: a table; a formation; either with a player missing;
    or a formation that changes after a minute.  Names are misspelt in the
    second frame, a wrong number is seen once, and the table's scores differ.
    """
    k, i, f = F.col("k"), F.col("i"), F.col("f")
    slots = read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("v"), F.col("s_nationkey").cast("string")).alias("video"))
    slots = slots.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(10)))).withColumn("f", F.explode(F.sequence(F.lit(0), F.when(k % 5 == 4, 5).otherwise(2))))
    slots = slots.filter(~(k % 5).isin(2, 3) | (i < 10)).withColumn("n_nationkey", (k + 2 * i + F.floor(f / 3) * 5) % 25)
    nations = read(spark, d, "nation")
    digest = F.substring(F.md5("n_name"), F.lit(1), (6 + F.col("n_nationkey") % 4).cast("int"))
    rows = slots.join(nations.select("n_nationkey", F.upper(F.translate(digest, "0123456789", "ghijklmnop")).alias("n_name")), "n_nationkey")
    table, late = k % 5 % 2 == 0, F.floor(f / 3)
    table = table & (k % 5 != 4)
    pitch = lambda places: F.element_at(F.array(*map(F.lit, places)), i + 1)
    shift = F.col("late") * 0.06
    rows = rows.withColumn("late", late).withColumn("table", table)
    x = F.when(F.col("table"), F.lit(0.2)).otherwise(0.12 + 0.2 * pitch(_PITCH_COLUMN) + shift)
    y = F.when(F.col("table"), 0.1 + 0.07 * i).otherwise(0.1 + 0.2 * pitch(_PITCH_ROW))
    number = F.when(F.col("late") > 0, 1 + (k * 7 + i * 8 + 50) % 99).otherwise(1 + (k * 13 + i * 8) % 99)
    seen = F.when((i == 3) & (f == 1) & F.col("table"), number % 99 + 1).otherwise(number)
    text = F.when((f % 3 == 1) & (F.length("n_name") >= 7), F.concat(F.expr("substring(n_name, 1, length(n_name) - 1)"), F.lit("X"))).otherwise(F.col("n_name"))
    rows = rows.select("k", "video", "i", "f", "late", "table", x.alias("bx"), y.alias("by"), seen.cast("string").alias("number"), text.alias("name"))
    base, time = (f * 11 + i) * 2, f * 0.5 + F.col("late") * 60
    common = [F.col("video"), k.cast("int").alias("segment_index"), (f + 1).cast("long").alias("frame_index"), time.alias("timestamp_seconds"), F.lit(100.0).alias("segment_end_seconds")]
    numbers = rows.select(*common, base.cast("long").alias("row_id"), F.col("number").alias("text"), F.lit(NUMBER).alias("text_type"), (0.8 + ((k + 3 * i + f) % 17) / 100).alias("score"), F.col("bx").alias("x"), F.col("by").alias("y"))
    names = rows.select(
        *common, (base + 1).cast("long").alias("row_id"), F.col("name").alias("text"), F.lit(TEXT_KIND).alias("text_type"), (0.7 + ((2 * k + 5 * i + 3 * f) % 23) / 100).alias("score"),
        F.when(F.col("table"), F.col("bx") + 0.1).otherwise(F.col("bx")).alias("x"), F.when(F.col("table"), F.col("by")).otherwise(F.col("by") + 0.078).alias("y"),
    )
    return numbers.unionByName(names)


FRAMES = f"""frames AS (
  SELECT user_id AS video, event_id, event_type, (epoch_us(ts) - epoch_us(TIMESTAMP '{EPOCH}')) / 1e6 AS t,
    least(value, 100::DOUBLE) / 100 AS score, (event_type = 'purchase')::INT AS label,
    CASE WHEN user_id % 20 < 3 THEN 'test' WHEN user_id % 20 < 6 THEN 'val' ELSE 'train' END AS split
  FROM events)"""


def smooth_sql(w: int) -> str:
    return f"avg(score) OVER (PARTITION BY video ORDER BY t ROWS BETWEEN {w // 2} PRECEDING AND {w // 2} FOLLOWING)"


def islands_sql(name: str, source: str, positive: str) -> str:
    return f"""{name}_a AS (
  SELECT *, t - lag(t) OVER o AS gap, lead(t) OVER o AS nxt, {positive} AS pos, lag({positive}) OVER o AS before
  FROM {source} WINDOW o AS (PARTITION BY video ORDER BY t)),
{name}_b AS (
  SELECT *, coalesce(median(CASE WHEN gap > 0 THEN gap END) OVER (PARTITION BY video), 0) AS step,
    sum(CASE WHEN pos AND NOT coalesce(before, false) THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY t) AS run
  FROM {name}_a),
{name} AS (
  SELECT video, min(t) AS "start", max(coalesce(nxt, t + step)) AS "end" FROM {name}_b WHERE pos GROUP BY video, run)"""


def merged_sql(name: str, source: str, gap: float, least: float) -> str:
    return f"""{name}_a AS (
  SELECT *, max("end") OVER (PARTITION BY video ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
{name}_b AS (
  SELECT *, sum(CASE WHEN coalesce("start" - reach > {gap}, true) THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY "start", "end") AS grp FROM {name}_a),
{name} AS (
  SELECT video, min("start") AS "start", max("end") AS "end" FROM {name}_b GROUP BY video, grp HAVING max("end") - min("start") >= {least})"""


SMOOTHED = f"{FRAMES},\nsmoothed AS (SELECT *, {smooth_sql(5)} AS smoothed FROM frames)"
RAW_SEGMENTS = f"{SMOOTHED},\n{islands_sql('raw', 'smoothed', 'smoothed >= 0.5')}"
PREDICTIONS = f"{RAW_SEGMENTS},\n{merged_sql('predictions', 'raw', GAP, LEAST)}"
TRUTH_PART = islands_sql("truths", "frames", "event_type IN ('purchase', 'view')")
TRUTHS = f"{FRAMES},\n{TRUTH_PART}"
BOTH = f"{PREDICTIONS},\n{TRUTH_PART}"
DETECTIONS = """lines AS (
  SELECT *, l_orderkey * 500 + row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n FROM lineitem),
based AS (
  SELECT l_returnflag || l_linestatus AS video, l_orderkey AS frame_index, 1 - l_discount AS score, n, p_size, p_name,
    0.8::DOUBLE * (l_partkey % 1000)::DOUBLE / 1000 AS bx, 0.8::DOUBLE * (l_suppkey % 100)::DOUBLE / 100 AS by_, l_linenumber AS line, l_quantity AS quantity
  FROM lines JOIN part ON l_partkey = p_partkey),
detections AS (
  SELECT video, frame_index, 2 * n AS row_id, p_size::VARCHAR AS text, 'shirt_number_candidate' AS text_type, score, bx AS x, by_ AS y FROM based
  UNION ALL
  SELECT video, frame_index, 2 * n + 1, p_name, 'text', score, bx + 0.01::DOUBLE * line, by_ + 0.012::DOUBLE * (quantity % 10) FROM based),
normed AS (SELECT *, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS norm FROM detections)"""
MATCHING = f"""{BOTH},
tn AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY "start", "end") AS i FROM truths),
pn AS (SELECT *, row_number() OVER (PARTITION BY video ORDER BY "start", "end") AS j FROM predictions),
pairs AS (
  SELECT tn.video, i, j, (least(tn."end", pn."end") - greatest(tn."start", pn."start")) /
    ((tn."end" - tn."start") + (pn."end" - pn."start") - (least(tn."end", pn."end") - greatest(tn."start", pn."start"))) AS iou
  FROM tn JOIN pn ON tn.video = pn.video AND tn."start" < pn."end" AND pn."start" < tn."end"),
sizes AS (SELECT video, n, m FROM (SELECT video, count(*) AS n FROM tn GROUP BY video) JOIN (SELECT video, count(*) AS m FROM pn GROUP BY video) USING (video)),
cells AS (
  SELECT s.video, s.n, s.m, list(coalesce(iou, 0) ORDER BY tn.i, pn.j) AS v
  FROM sizes s JOIN tn ON tn.video = s.video JOIN pn ON pn.video = s.video LEFT JOIN pairs ON pairs.video = s.video AND pairs.i = tn.i AND pairs.j = pn.j GROUP BY s.video, s.n, s.m),
-- The best sums of the first i truths and j predictions, cell by cell; step: 1 leaves out the truth, 2 the prediction, 3 pairs them.
sums AS (
  SELECT video, n, m, v, 0::BIGINT AS k, []::STRUCT(s DOUBLE, c INT, step INT)[] AS best FROM cells
  UNION ALL
  SELECT video, n, m, v, k + 1, list_append(best, CASE WHEN iou > 0 AND row(round(d.s + iou, 12), d.c + 1) > row(round(u.s, 12), u.c) THEN {{'s': d.s + iou, 'c': d.c + 1, 'step': 3}} ELSE u END)
  FROM (
    SELECT video, n, m, v, k, best, iou, d, CASE WHEN row(round(l.s, 12), l.c) > row(round(u.s, 12), u.c) THEN {{'s': l.s, 'c': l.c, 'step': 2}} ELSE {{'s': u.s, 'c': u.c, 'step': 1}} END AS u
    FROM (
      SELECT *, v[k + 1] AS iou, CASE WHEN k >= m THEN best[k - m + 1] ELSE z END AS u, CASE WHEN k % m > 0 THEN best[k] ELSE z END AS l,
        CASE WHEN k >= m AND k % m > 0 THEN best[k - m] ELSE z END AS d
      FROM (SELECT *, {{'s': 0::DOUBLE, 'c': 0::INT, 'step': 0::INT}} AS z FROM sums WHERE k < n * m)))),
solved AS (SELECT video, n, m, best FROM sums WHERE k = n * m),
walk AS (
  SELECT video, n AS i, m AS j, best[n * m].step AS step FROM solved
  UNION ALL
  SELECT w.video, w.i, w.j, CASE WHEN w.i > 0 AND w.j > 0 THEN f.best[(w.i - 1) * f.m + w.j].step END
  FROM (SELECT video, i - (step <> 2)::INT AS i, j - (step <> 1)::INT AS j FROM walk WHERE step IS NOT NULL) w JOIN solved f ON f.video = w.video),
matched AS (SELECT video, i, j FROM walk WHERE step = 3)"""
DETAILS = f"""{MATCHING},
details AS (
  SELECT tn.video, tn.i, m.j, tn."start" AS ts, tn."end" AS te, pn."start" AS ps, pn."end" AS pe, coalesce(pairs.iou, 0) AS iou,
    CASE WHEN m.j IS NULL THEN 'missed' WHEN pairs.iou >= 0.5 THEN 'detected' ELSE 'below_iou_threshold' END AS status
  FROM tn LEFT JOIN matched m ON m.video = tn.video AND m.i = tn.i LEFT JOIN pn ON pn.video = tn.video AND pn.j = m.j
    LEFT JOIN pairs ON pairs.video = tn.video AND pairs.i = tn.i AND pairs.j = m.j
  UNION ALL
  SELECT pn.video, NULL, pn.j, NULL, NULL, pn."start", pn."end", 0, 'extra_prediction'
  FROM pn ANTI JOIN matched m ON m.video = pn.video AND m.j = pn.j)"""
BY_SERIES = f"""{DETAILS},
gaps AS (SELECT * FROM (SELECT video, "end" AS g, lead("start") OVER (PARTITION BY video ORDER BY "start", "end") AS h FROM truths) WHERE h IS NOT NULL),
gapped AS (
  SELECT g.video, sum(greatest(0, h - g)) AS gap_duration,
    sum((SELECT coalesce(sum(greatest(0, least(g.h, p."end") - greatest(g.g, p."start"))), 0) FROM predictions p WHERE p.video = g.video)) AS gap_false_positive
  FROM gaps g GROUP BY g.video),
counted AS (
  SELECT video, count(i) AS truth_segments, count(j) AS predicted_segments, count(*) FILTER (status = 'detected') AS detected_segments,
    avg(iou) FILTER (i IS NOT NULL) AS mean_iou_all, avg(iou) FILTER (status = 'detected') AS mean_iou_detected,
    avg(abs(ps - ts)) FILTER (status = 'detected') AS start_mae, avg(abs(pe - te)) FILTER (status = 'detected') AS end_mae
  FROM details GROUP BY video),
series AS (
  SELECT video, coalesce(truth_segments, 0) AS truth_segments, coalesce(predicted_segments, 0) AS predicted_segments, coalesce(detected_segments, 0) AS detected_segments,
    mean_iou_all, mean_iou_detected, start_mae, end_mae, coalesce(gap_duration, 0) AS gap_duration, coalesce(gap_false_positive, 0) AS gap_false_positive
  FROM (SELECT DISTINCT video FROM frames) LEFT JOIN counted USING (video) LEFT JOIN gapped USING (video))"""
RATES = """predicted_segments - detected_segments AS false_positive_segments, truth_segments - detected_segments AS missed_segments,
  round(coalesce(detected_segments / nullif(predicted_segments, 0), 0), 9) AS segment_precision,
  round(coalesce(detected_segments / nullif(truth_segments, 0), 0), 9) AS segment_recall,
  round(coalesce(2 * detected_segments / nullif(predicted_segments + truth_segments, 0), 0), 9) AS segment_f1,
  round(CASE WHEN gap_duration > 0 THEN 1 - gap_false_positive / gap_duration END, 9) AS gap_preservation"""

#: The players that the rule of lineups() leads to, from its formulas and not from its rows.
LINEUPS = f"""slots AS (
  SELECT s_suppkey AS k, 'v' || s_nationkey AS video, i, late, k % 5 IN (0, 2) AS tab, (k + 2 * i + late * 5) % 25 AS nation,
    CASE WHEN late > 0 THEN 1 + (k * 7 + i * 8 + 50) % 99 ELSE 1 + (k * 13 + i * 8) % 99 END AS number,
    {list(_PITCH_ROW)}[i + 1] AS pitch_row, 0.12 + 0.2 * {list(_PITCH_COLUMN)}[i + 1] + 0.06 * late AS pitch_x
  FROM (SELECT *, s_suppkey AS k FROM supplier), range(11) r(i), range(2) l(late) WHERE k % 5 NOT IN (2, 3) AND (late = 0 OR k % 5 = 4)),
names AS (SELECT n_nationkey, upper(translate(substr(md5(n_name), 1, 6 + n_nationkey % 4), '0123456789', 'ghijklmnop')) AS n_name FROM nation),
players AS (SELECT slots.*, n_name, length(n_name) >= 7 AS misspelt FROM slots JOIN names ON n_nationkey = nation),
shots AS (
  SELECT *, 3 * late + g AS f, 0.8 + ((k + 3 * i + 3 * late + g) % 17) / 100 AS ns, 0.7 + ((2 * k + 5 * i + 9 * late + 3 * g) % 23) / 100 AS ts,
    tab AND i = 3 AND g = 1 AS wrong, misspelt AND g = 1 AS typo FROM players, range(3) t(g)),
found AS (
  SELECT k, video, i, late, tab, number, n_name, pitch_row, pitch_x, count(*) FILTER (NOT wrong) AS seen,
    avg(ns) FILTER (NOT wrong) AS number_score, avg(ts) FILTER (NOT typo AND NOT wrong) AS label_score, avg(sqrt(ns * ts)) FILTER (NOT wrong) AS pair_score,
    count(*) FILTER (NOT wrong) AS label_frames, avg(ts) AS any_score
  FROM shots GROUP BY ALL)"""
