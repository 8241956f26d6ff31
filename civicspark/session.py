"""Session settings, the shared working folder, and shuffle sizing."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Day counts, months and hours depend on the zone, so it is pinned.  The adaptive settings
# are Spark's defaults, stated because the joins here rely on them to split hot keys.  Layers and
# staged tables are written more often than they are read, and zstd makes them smaller than snappy.
# Writing takes most of its time in encoding: times as 96 bits (Spark's default), and dictionaries of
# columns in which nearly every row has a value of its own, cost a quarter of it and save no space.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "parquet.enable.dictionary#unique_key": "false",
    "parquet.enable.dictionary#bbl": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Shuffle files otherwise stay until the driver happens to collect its garbage: all those of a run
# of many steps at once.  Frames that are executed again would have to shuffle again, so this is for
# sessions of steps and for writes, not for frames that a caller gets.
RELEASE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INHERITED = ("spark.sql.shuffle.partitions",)
BYTES_PER_REDUCER = 256 * 1024 * 1024

_local_folders: dict[str, str] = {}
#: Tables and folders staged by each application, until they are released.
_staged: dict[str, list[str]] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def own_session(spark: SparkSession) -> SparkSession:
    """A session of its own over the same context and catalog, so that a step's settings neither
    meet nor outlive those of its caller."""
    session = prepare(spark.newSession())
    for name, value in RELEASE_SHUFFLES.items():
        session.conf.set(name, value)
    for name in INHERITED:
        value = spark.conf.get(name, None)
        if value is not None:
            session.conf.set(name, value)
    return session


@contextmanager
def settings(session: SparkSession, values: dict[str, str]):
    """The session's settings changed for a while."""
    before = {name: session.conf.get(name, None) for name in values}
    for name, value in values.items():
        session.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                session.conf.unset(name)
            else:
                session.conf.set(name, value)


def releasing(df: DataFrame):
    """While this holds, writes of ``df`` delete their shuffle files when they are done."""
    return settings(df.sparkSession, RELEASE_SHUFFLES)


def bytes_read(df: DataFrame) -> int:
    """Bytes of the files that the plan of ``df`` reads, after partition pruning.  Nothing is
    run, and no folder listed that the plan does not read."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.nodeName().startswith("Scan") and "ExistingRDD" not in leaf.nodeName():
            files = getattr(leaf, "selectedPartitions", None)
            total += files().totalFileSize() if files else 0
    return total


def size_shuffles(session: SparkSession, *frames: DataFrame) -> None:
    """Start the session's shuffles with one reducer per 256 MB of what ``frames`` read; adaptive
    execution merges the small ones.  Never fewer than the session's own partition count."""
    needed = -(-sum(map(bytes_read, frames)) // BYTES_PER_REDUCER)
    floor = int(session.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set(INITIAL_PARTITIONS, str(max(floor, needed)))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A local master without that setting gets a fresh temporary folder; a cluster without it
    is an error, because a machine-local folder would lose data with its machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="civicspark-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    path = f"{shared_dir(spark)}/civicspark/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_database(spark: SparkSession) -> str:
    """The database of staged tables; named by its folder, so that a catalog that outlives the
    session never points to another session's folder."""
    folder = f"{shared_dir(spark)}/civicspark_scratch"
    name = f"civicspark_scratch_{hashlib.md5(folder.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
    return name


def stage_table(
    df: DataFrame,
    label: str,
    key: str | None = None,
    buckets: int | None = None,
    options: dict[str, str] | None = None,
) -> str:
    """Write ``df`` to a new table in the shared folder, bucketed by ``key`` if ``buckets`` are given,
    and return the table's name.  ``options`` are those of the Parquet writer.

    Cuts the lineage and lets several consumers share one pass; unlike a cache it does not
    have to be recomputed when an executor is lost."""
    spark = df.sparkSession
    name = f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, key) if buckets else df.write
    with releasing(df):
        writer.options(**options or {}).saveAsTable(name, format="parquet")
    _staged.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def drop_staged(spark: SparkSession, name: str) -> None:
    """Delete a staged table with its files, once nothing reads it any more."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    mine = _staged.get(spark.sparkContext.applicationId, [])
    if name in mine:
        mine.remove(name)


def remove_folders(spark: SparkSession, *paths: str) -> None:
    """Delete folders with all they hold, through the file system Spark uses for them."""
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged.  Frames that read it cannot be read again."""
    for name in list(_staged.pop(spark.sparkContext.applicationId, [])):
        if "/" in name:
            remove_folders(spark, name)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def materialize(
    df: DataFrame, label: str, options: dict[str, str] | None = None
) -> DataFrame:
    """``df`` staged; for results that go on being read, until ``release``."""
    return df.sparkSession.table(stage_table(df, label, options=options))
