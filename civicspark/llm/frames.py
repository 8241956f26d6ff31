"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.session import shared_dir


#: Bytes of rows that a Python worker is sent at a time, unless the session sets another number.
#: Texts differ so much in length that a number of rows, Spark's other limit, says little.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Large arrays of Python workers go back to the system when freed; a worker that waits for its next
#: task otherwise holds on to all it ever needed.
_WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "1000000",
}


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where the driver found it, and
    send them rows in batches of bounded bytes.  To other machines the library is shipped with
    ``--py-files``, as any library."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    for name, value in _WORKER_MEMORY.items():
        environment.setdefault(name, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(frame: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each changed until no column of the frame has it."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def cut(frame: DataFrame) -> DataFrame:
    """``frame`` stored in the folder that all executors share, its lineage cut."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(shared_dir(frame.sparkSession), "checkpoints"))
    return frame.checkpoint()
