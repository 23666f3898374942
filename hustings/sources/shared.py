"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: Folders handed out by this process that discard() deletes.
_handed: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder, as a URI, below the one that the cluster names in spark.checkpoint.dir.

    Where that is unset, a local session (as in tests) gets a temporary folder of this machine; any other is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not held.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = held.get() if held.isDefined() else tempfile.mkdtemp(prefix="checkpoints-")
    if "://" not in base:
        base = f"file://{base.removeprefix('file:')}"
    _handed.append(f"{base.rstrip('/')}/{uuid.uuid4().hex}")
    return _handed[-1]


def discard(spark: SparkSession) -> None:
    """Deletes every folder that shared_folder() handed out so far. For when results are stored: DataFrames that operators
    returned before can't be computed after it."""
    jvm = spark.sparkContext._jvm
    while _handed:
        path = jvm.org.apache.hadoop.fs.Path(_handed.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_checkpoints(spark: SparkSession) -> None:
    """Sees to it that DataFrame.checkpoint() has a folder; a cluster's own setting stays."""
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


#: Bytes of an Arrow batch that operators on whole texts send to Python at most.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the size of the session's Arrow batches to BATCH_BYTES where it allows more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = int(str(spark.conf.get(name)).rstrip("b"))
    if held > BATCH_BYTES or held <= 0:
        spark.conf.set(name, str(BATCH_BYTES))
