"""Sinks: partitioned tables, fixed columns, clip jobs."""

from __future__ import annotations

import os
import subprocess
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanwright.functions.text import clip_name, path_stem, safe_stem
from spanwright.functions.timetext import tag_of


def with_columns(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns, in order; an empty frame keeps its schema."""
    return frame.select(*columns)


def write_partitioned(frame: DataFrame, path: str, key: str = "video_id") -> None:
    """A folder for each key; only the folders of keys that are written are replaced."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def printed(frame: DataFrame, title: str = "", most: int = 100) -> str:
    """The first rows of a small frame as lines of ``name=value``, printed and returned."""
    rows = frame.limit(most + 1).collect()
    lines = [title] * bool(title) + ["  ".join(f"{k}={v}" for k, v in row.asDict().items()) for row in rows[:most]] + ["..."] * (len(rows) > most)
    text = "\n".join(lines)
    print(text)
    return text


def as_json(frame: DataFrame, name: str = "json") -> DataFrame:
    """One JSON object for each row, nulls included."""
    return frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def write_json(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def clip_jobs(segments: DataFrame, folder: str = "", fold: bool = True) -> DataFrame:
    """A row for each segment with its number, length and output name."""
    order = Window.partitionBy("video").orderBy("start", "end")
    out = segments.withColumn("number", F.row_number().over(order)).withColumn("duration", F.col("end") - F.col("start"))
    name = clip_name(safe_stem(path_stem(F.col("video").cast("string")), fold), F.col("number"), tag_of(F.col("start")), tag_of(F.col("end")))
    return out.withColumn("output", F.concat(F.lit(folder), name))


def repeated_outputs(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("output").agg(F.count("*").alias("n")).filter("n > 1")


def missing_sources(jobs: DataFrame, files: DataFrame, key: str = "video") -> DataFrame:
    return jobs.select(key).distinct().join(files.select(key), key, "left_anti")


def checked_jobs(jobs: DataFrame, files: DataFrame, overwrite: bool = False, most: int = 10) -> DataFrame:
    """The jobs (source, output), or an error that names what stands against them:
    sources that ``files`` (path) lacks, outputs of several jobs, outputs that exist."""

    def names(rows: DataFrame, column: str) -> list[str]:
        return [r[0] for r in rows.select(column).distinct().orderBy(column).limit(most).collect()]

    paths = files.select("path")
    faults = [("no such source", names(jobs.join(paths, F.col("source") == F.col("path"), "left_anti"), "source")), ("several jobs write", names(repeated_outputs(jobs), "output"))]
    if not overwrite:
        faults.append(("already there", names(jobs.join(paths, F.col("output") == F.col("path"), "left_semi"), "output")))
    if found := [f"{what}: {', '.join(which)}" for what, which in faults if which]:
        raise ValueError("; ".join(found))
    return jobs


# The arguments of the encoder.
STREAMS = ("-map", "0:v:0", "-map", "0:a:0?")
ENCODE = ("-c:v", "libx264", "-preset", "fast", "-crf", "18", "-c:a", "aac", "-b:a", "192k", "-movflags", "+faststart")
COPY = ("-c", "copy", "-avoid_negative_ts", "make_zero")


def clip_command(source: str, start: float, duration: float, output: str, ffmpeg: str = "ffmpeg", copy: bool = False) -> list[str]:
    """The first picture stream and, if there is one, the first sound stream of a part of a video."""
    cut = ["-ss", f"{start:.3f}", "-i", source, "-t", f"{duration:.3f}"]
    return [ffmpeg, "-hide_banner", "-loglevel", "error", "-y", *cut, *STREAMS, *(COPY if copy else ENCODE), output]


def export_clips(jobs: DataFrame, run=subprocess.run, **options) -> None:
    """Run each job's command in its task: to a file beside the output, then renamed.

    ``jobs`` needs source, start, duration and output on a file system that
    the executors share.  A task that is run again replaces its outputs whole.
    """

    def export(rows: Iterable) -> None:
        for job in rows:
            folder = os.path.dirname(job["output"]) or "."
            os.makedirs(folder, exist_ok=True)
            handle, part = tempfile.mkstemp(suffix=os.path.splitext(job["output"])[1], dir=folder)
            os.close(handle)
            try:
                run(clip_command(job["source"], job["start"], job["duration"], part, **options), check=True)
                os.chmod(part, 0o644)
                os.replace(part, job["output"])
            finally:
                if os.path.exists(part):
                    os.unlink(part)

    jobs.select("source", "start", "duration", "output").foreachPartition(export)
