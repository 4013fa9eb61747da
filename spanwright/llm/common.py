"""What the operators of this subpackage share: tables, cut lineage, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of at most a few dozen bytes that may be broadcast; counted before.
BROADCAST_ROWS = 1_000_000
#: Rows of a few dozen bytes that one task takes, where their number is known.
TASK_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which driver and executors share.

    It is the cluster's ``spark.checkpoint.dir``; a session on one machine that
    has none (as in tests) gets a temporary one, any other raises.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared checkpoint folder and read it from there."""
    _shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


class Tables:
    """Tables written to the shared folder between the steps of one operator.

    They cut lineage as a checkpoint does, but are read by columns, in as many
    tasks as their size asks for, and are deleted as soon as they are dropped;
    what is left goes at the end of the ``with`` block.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, _shared_folder(spark)
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        for path in [p for _, p in self.paths.values()]:
            self._delete(path)
        self.paths.clear()

    def keep(self, frame: DataFrame) -> DataFrame:
        path = f"{self.folder}/table-{uuid.uuid4().hex}"
        frame.write.parquet(path)
        found = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(found)] = found, path
        return found

    def keep_as(self, table: DataFrame, view: DataFrame) -> DataFrame:
        """``view``, a projection of a kept table, to be dropped in its place."""
        self.paths[id(view)] = view, self.paths.pop(id(table))[1]
        return view

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(self.paths.pop(id(table))[1])

    def _delete(self, path: str) -> None:
        jvm, java = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(java.hadoopConfiguration()).delete(at, True)


def tasks_for(rows: int) -> int:
    """Tasks for a number of rows of a few dozen bytes; for ``coalesce``, so at most."""
    return max(1, -(-rows // TASK_ROWS))


#: Rows and bytes of an Arrow batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bounded_batches(frame: DataFrame) -> DataFrame:
    """The frame, after lowering the session's limits on Arrow batches.

    Spark's ten thousand rows are hundreds of megabytes where texts are long,
    in the JVM and in each Python worker.
    """
    conf, prefix = frame.sparkSession.conf, "spark.sql.execution.arrow"
    if not 0 < int(conf.get(f"{prefix}.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set(f"{prefix}.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set(f"{prefix}.maxBytesPerBatch", str(BATCH_BYTES))
    return frame


def checked_broadcast(frame: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``most`` rows, else as it is.

    Call it on a cut or otherwise cheap frame: its rows are counted, up to the
    bound.  Beyond the bound Spark joins by shuffle.
    """
    if frame.limit(most + 1).count() <= most:
        return F.broadcast(frame)
    return frame


def rows_of(big: DataFrame, ids: DataFrame, key: str, small=checked_broadcast) -> DataFrame:
    """Rows of ``big`` whose key is in ``ids`` (distinct keys, cheap to count)."""
    return big.join(small(ids.select(key)), key, "left_semi")
