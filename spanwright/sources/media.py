"""Images and frames of videos as rows, with decoders that a caller brings.

No codec is part of this package.  ``Decoder`` turns a file's bytes into
pixels, ``OpenVideo`` opens a video for reading frames by time; both are made
once for each task.  ``pnm`` decodes portable pixmaps, as a built-in example.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwright.functions.timetext import frame_name
from spanwright.operators.intervals import time_grid
from spanwright.sources.tables import listed_files

#: Pixels, rows by columns by three channels of 0 to 255; raises ValueError for bytes that are no image.
Decoder = Callable[[bytes], np.ndarray]
# Fixed value: the suffixes of images.
IMAGE_SUFFIXES = (".jpeg", ".jpg", ".pgm", ".png", ".ppm")


class Video(Protocol):
    """An open video."""

    def frame(self, milliseconds: float) -> bytes | None:
        """The encoded picture at a time; None if there is none."""

    def close(self) -> None: ...


OpenVideo = Callable[[str], Video]


def pnm(data: bytes) -> np.ndarray:
    """A binary portable pixmap or greymap of 8 bits."""
    fields, at = [], 0
    while len(fields) < 4:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            at = data.find(b"\n", at) + 1 or len(data) if data[at : at + 1] == b"#" else at + 1
        stop = at
        while stop < len(data) and not data[stop : stop + 1].isspace():
            stop += 1
        if stop == at:
            raise ValueError("no portable pixmap")
        fields.append(data[at:stop])
        at = stop
    kind = fields[0]
    width, height, most = (int(f) if f.isdigit() else 0 for f in fields[1:])
    channels = {b"P5": 1, b"P6": 3}.get(kind)
    pixels = np.frombuffer(data, np.uint8, offset=min(at + 1, len(data)))
    if channels is None or not 0 < most < 256 or len(pixels) < width * height * channels or not width * height:
        raise ValueError("no portable pixmap of 8 bits")
    found = pixels[: width * height * channels].reshape(height, width, channels)
    return np.repeat(found, 3, axis=2) if channels == 1 else found


def images(spark: SparkSession, folder: str, make: Callable[[], Decoder] = lambda: pnm, size: int = 192, suffixes: tuple = IMAGE_SUFFIXES, faults: bool = False) -> DataFrame:
    """(path, width, height, pixels) of the images of a folder.

    ``pixels`` are size * size * 3 shares of 0 to 1, row by row, by the nearest
    pixel.  A file that is no image raises; with ``faults`` it has null sizes
    and pixels, and its error in column ``fault``.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = make()
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    image, fault = decoder(content.as_py()), None
                except ValueError as error:
                    if not faults:
                        raise ValueError(f"{path}: {error}") from error
                    image, fault = None, str(error)
                row: dict = {"path": path, "width": None, "height": None, "pixels": None, "fault": fault}
                if image is not None:
                    height, width = image.shape[:2]
                    rows, columns = (np.arange(size) * n // size for n in (height, width))
                    row |= {"width": width, "height": height, "pixels": (image[rows][:, columns].reshape(-1) / 255).astype(np.float32)}
                yield pa.RecordBatch.from_pylist([row], SCHEMA)

    out = files.filter(suffix.isin(*suffixes)).mapInArrow(decode, "path string, width int, height int, pixels array<float>, fault string")
    return out if faults else out.drop("fault")


SCHEMA = pa.schema([("path", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.list_(pa.float32())), ("fault", pa.string())])


def video_frames(videos: DataFrame, open_video: OpenVideo, per_second: float, key: str = "video", path: str = "path", start: str = "start", end: str = "end") -> DataFrame:
    """(key, frame_index, t, name, picture): the pictures of videos at the times of a grid.

    Videos are dealt to tasks by path, and each task opens a video once and
    seeks to its times in order; times without a picture have no row.
    """
    grid = time_grid(videos.select(key, path, start, end), per_second, start, end)
    grid = grid.select(key, path, "frame_index", "t", frame_name(F.col("frame_index"), (F.col("t") * 1000).cast("long")).alias("name"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grid.schema if f.name != path) + ", picture binary"
    at = grid.columns.index(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, video = None, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row[path] != now:
                        if video is not None:
                            video.close()
                        now, video = row[path], open_video(row[path])
                    picture = video.frame(row["t"] * 1000)
                    if picture is not None:
                        kept = pa.schema([f for i, f in enumerate(batch.schema) if i != at] + [pa.field("picture", pa.binary())])
                        yield pa.RecordBatch.from_pylist([{k: v for k, v in row.items() if k != path} | {"picture": picture}], kept)
        finally:
            if video is not None:
                video.close()

    return grid.repartition(path).sortWithinPartitions(path, "t").mapInArrow(read, schema)


def images_missing(frames: DataFrame, folder: str, path: str = "frame_path", most: int = 10) -> list[str]:
    """The first paths of ``frames``, by name, that the folder lacks."""
    files = listed_files(frames.sparkSession, folder, IMAGE_SUFFIXES).select(F.regexp_replace("path", "^[a-z]+:/*(?=/)", "").alias("__path"))
    rows = frames.select(F.col(path).alias("__path")).distinct().join(files, "__path", "left_anti").orderBy("__path").limit(most).collect()
    return [r[0] for r in rows]
