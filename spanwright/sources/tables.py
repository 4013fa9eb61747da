"""Sources: shared tables, CSV with fixed schemas, listings, results of recognisers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from spanwright.functions.text import nfc, parent_name
from spanwright.functions.timetext import checked_seconds, range_of

# Fixed value: the suffixes of video files.
VIDEO_SUFFIXES = (".avi", ".m4v", ".mkv", ".mov", ".mp4", ".webm")
# Columns of the files.
TRUTH = "video string, `Đội 1` string, `Đội 2` string"
FRAME_LABELS = "video string, frame_path string, timestamp string, timestamp_seconds double, label int"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require(frame: DataFrame, columns) -> DataFrame:
    """The frame, or an error that names the columns it lacks; no job."""
    if missing := sorted(set(columns) - set(frame.columns)):
        raise ValueError(f"missing columns: {missing}")
    return frame


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header and a declared schema; malformed values raise."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def frame_labels(spark: SparkSession, pattern: str, schema: str = FRAME_LABELS) -> DataFrame:
    """All label files of a pattern such as ``labels/*/frame_labels.csv``; the
    series' id is the name of a file's folder."""
    rows = read_csv(spark, pattern, schema).select("*", F.col("_metadata.file_path").alias("source_labels_csv"))
    return rows.withColumn("video_id", F.url_decode(parent_name(F.col("source_labels_csv"))))


def listed_files(spark: SparkSession, folder: str, suffixes: tuple = VIDEO_SUFFIXES) -> DataFrame:
    """(path, length), by path, of the files of a folder with one of the suffixes;
    contents aren't read, and a folder that isn't there raises."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    return files.filter(suffix.isin(*suffixes)).orderBy("path")


#: Names of a caller's list that may be broadcast.
MOST_NAMES = 100_000


def chosen(files: DataFrame, names: list[str], name: str = "name") -> DataFrame:
    """The rows of the names, with their place in the request; an error for names without a row."""
    wanted = files.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)], f"{name} string, request_index int")
    lost = [r[0] for r in wanted.join(files, name, "left_anti").orderBy("request_index").limit(10).collect()]
    if lost:
        raise ValueError(f"not found: {lost}")
    return files.join(F.broadcast(wanted) if len(names) <= MOST_NAMES else wanted, name)


def one_of_each(rows: DataFrame, key: str, order: list[str], last: bool = True) -> DataFrame:
    """The last (or first) row of each key, as a map that is filled in this order has it."""
    by = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*by))).filter("__n = 1").drop("__n")


def missing_files(rows: DataFrame, files: DataFrame, column: str = "frame_path", most: int = 10) -> tuple[int, list[str]]:
    """How many different paths of ``rows`` are not in ``files`` (path), and the first of them by name."""
    lost = rows.select(F.col(column).alias("path")).filter("path is not null").distinct().join(files.select("path"), "path", "left_anti")
    return lost.count(), [r[0] for r in lost.orderBy("path").limit(most).collect()]


def resolved_paths(rows: DataFrame, files: DataFrame, folder: str, fallback: str, column: str = "video") -> DataFrame:
    """The rows with column ``source``: an absolute path as it is; else below
    ``folder`` if ``files`` (path) has it there, else below ``fallback`` if it is
    there, else below ``folder``."""
    absolute = F.col(column).startswith("/")
    first, second = (F.concat(F.lit(f.rstrip("/") + "/"), F.col(column)) for f in (folder, fallback))
    known = files.select(F.col("path").alias("__known")).distinct()
    out = rows.withColumn("__first", first).withColumn("__second", second)
    out = out.join(known, F.col("__first") == F.col("__known"), "left").withColumn("__has_first", F.col("__known").isNotNull()).drop("__known")
    out = out.join(known, F.col("__second") == F.col("__known"), "left").withColumn("__has_second", F.col("__known").isNotNull()).drop("__known")
    source = F.when(absolute, F.col(column)).when(~F.col("__has_first") & F.col("__has_second"), F.col("__second")).otherwise(F.col("__first"))
    return out.withColumn("source", source).drop("__first", "__second", "__has_first", "__has_second")


# Columns of a table of detections, and those of them that are numbers.
DETECTION_NUMBERS = ("segment_index", "segment_start_seconds", "segment_end_seconds", "frame_index", "timestamp_seconds", "score", "center_x_norm", "center_y_norm")
DETECTION_COLUMNS = ("video", "text", "text_type", *DETECTION_NUMBERS)


def detections(rows: DataFrame) -> DataFrame:
    """Detections as the resolvers take them, from a table of strings or numbers.

    A missing column or an empty table raises; a number that is none, isn't
    finite, or a share outside 0 to 1, raises when the result is computed.
    Texts are stripped, and rows without one are left out.  Rows are numbered
    in their order (row_id), and centres are also named x and y.
    """
    require(rows, DETECTION_COLUMNS)
    if not rows.limit(1).count():
        raise ValueError("no detections")

    def number(name: str):
        value = F.col(name).cast("string").try_cast("double")
        good = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
        good = good & value.between(0, 1) if name in ("score", "center_x_norm", "center_y_norm") else good
        return F.when(good, value).otherwise(F.raise_error(F.concat(F.lit(f"not a {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("double"))

    whole = ("segment_index", "frame_index")
    out = rows.select(
        *(number(c).cast("int" if c in whole else "double").alias(c) if c in DETECTION_NUMBERS else F.trim(c).alias(c) if c == "text" else F.col(f"`{c}`") for c in rows.columns),
        F.monotonically_increasing_id().alias("row_id"),
    )
    return out.filter("text <> ''").withColumns({"x": F.col("center_x_norm"), "y": F.col("center_y_norm"), "frame_index": F.col("frame_index").cast("long")})


def checkpoint(spark: SparkSession, path: str, architecture: str) -> dict:
    """A checkpoint of one JSON object, checked."""
    from spanwright.operators.scoring import checked_checkpoint

    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a checkpoint is one file: {path}")
    return checked_checkpoint(json.loads(rows[0][0]), architecture)


def truth_ranges(rows: DataFrame, strict_order: bool = False) -> DataFrame:
    """(video, team, start, end) of a truth table with a column of ranges for each team.

    Names are stripped and composed; an empty or repeated name, a range that
    doesn't parse, or overlapping ranges raise when the result is computed.
    """
    teams = [c for c in rows.columns if c != "video"]
    long = rows.select(nfc("video").alias("video"), F.posexplode(F.array(*(F.struct(F.lit(c).alias("team"), F.col(f"`{c}`").alias("text")) for c in teams))).alias("place", "r"))
    long = long.select("video", "place", "r.team", "r.text", range_of(F.col("r.text")).alias("x"))
    of = Window.partitionBy("video", "place")
    order = Window.partitionBy("video").orderBy("place" if strict_order else "start")
    rows = long.withColumn("copies", F.count("*").over(of)).select("video", "team", "text", "copies", "place", F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    rows = rows.withColumn("before", F.lag("end").over(order))
    fault = (
        F.when(F.coalesce(F.col("video"), F.lit("")) == "", "empty name").when(F.col("copies") > 1, "repeated name").when(F.col("start").isNull(), "not a range")
        .when(F.col("start") < F.col("before"), "overlapping ranges")
    )
    good = F.when(fault.isNull(), F.col("start")).otherwise(F.raise_error(F.concat_ws(": ", fault, "video", "text")).cast("double"))
    return rows.select("video", "team", good.alias("start"), "end")


def segment_table(rows: DataFrame, key: str = "video", order: str = "start") -> DataFrame:
    """(video, segment_index, segment, start, end) of a segment table.

    Seconds win over times as text; segments without a label are numbered;
    ends at or before starts raise.
    """
    def side(name: str):
        seconds, text = f"{name}_seconds", name
        parts = ([F.col(seconds).cast("double")] if seconds in rows.columns else []) + ([checked_seconds(F.col(text).cast("string"))] if text in rows.columns else [])
        if not parts:
            raise ValueError(f"missing columns: {[seconds]} or {[text]}")
        return F.coalesce(*parts)

    out = rows.select(key, side("start").alias("start"), side("end").alias("end"), *([F.col("segment")] if "segment" in rows.columns else [F.lit(None).cast("string").alias("segment")]))
    out = out.withColumn("end", F.when(F.col("end") > F.col("start"), F.col("end")).otherwise(F.raise_error(F.lit("a segment must end after its start")).cast("double")))
    out = out.withColumn("segment_index", F.row_number().over(Window.partitionBy(key).orderBy(order, "end")))
    label = F.coalesce(F.nullif(F.trim("segment"), F.lit("")), F.format_string("lineup_%02d", F.col("segment_index")))
    return out.select(key, "segment_index", label.alias("segment"), "start", "end")


def unwrapped(json: str, inner: str):
    """A recogniser's result as a struct, from JSON with or without a ``res`` envelope."""
    return F.coalesce(F.from_json(json, f"res struct<{inner}>")["res"], F.from_json(json, f"{inner}"))
