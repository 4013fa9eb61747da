"""Shipping the package to executors whose Python can't import it yet."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's executors, once for each context.

    Spark serves the archive itself, so driver and executors need no shared
    folder, and executors that join later get it too.
    """
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context)
