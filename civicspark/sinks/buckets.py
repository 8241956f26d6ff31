"""Partitioned Parquet tables that are also bucketed by key.

A merge matches a batch with the rows of a table by key.  The table's rows lie in buckets, so only the
batch is shuffled: into the same buckets, in the shuffle that finds its latest versions.  The rows that
stay and those of the batch are still dealt into buckets, and are written as they are, sorted inside every file.

The folder remains a plain partitioned Parquet folder for its readers.  Its number of buckets is
stored in it, where a rebuild removes it with everything else; sessions declare the table from it,
whatever catalog they have.  A folder without that number is an unbucketed table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from civicspark.session import (
    INITIAL_PARTITIONS,
    RELEASE_SHUFFLES,
    bytes_read,
    scratch_database,
    settings,
)
from civicspark.sinks.tables import LAYOUT_COLUMN
from civicspark.sources.state import read_state, write_state

#: Bytes of input files that one bucket should hold at most, and at least while there are fewer
#: buckets than shuffle partitions.
MOST_BYTES = 64 * 1024 * 1024
LEAST_BYTES = 16 * 1024 * 1024

_PARTITIONS = "spark.sql.shuffle.partitions"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_MANAGED = "spark.sql.hive.manageFilesourcePartitions"
_LISTED_BY_DRIVER = "spark.sql.sources.parallelPartitionDiscovery.threshold"


def dealt_into(df: DataFrame, buckets: int | None):
    """While this holds, shuffles of ``df`` by key start with a partition per bucket, so that a task
    holds whole buckets and writes one file for each.  Streams shuffle without adaptive execution."""
    values = dict.fromkeys((INITIAL_PARTITIONS, _PARTITIONS), str(buckets)) if buckets else {}
    return settings(df.sparkSession, values)


def buckets_for(df: DataFrame) -> int:
    """How many buckets a table made from ``df`` should have."""
    size, most = bytes_read(df), int(df.sparkSession.conf.get(_PARTITIONS))
    if not size:  # not from files
        return most
    return max(-(-size // MOST_BYTES), min(most, -(-size // LEAST_BYTES)))


def _mark(path: str) -> str:
    return f"{path}/_buckets"


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """The number of buckets of the table at ``path``; None if it is not bucketed."""
    return int(read_state(spark, _mark(path), "0")) or None


def _declare(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    cluster: Sequence[str],
    buckets: int,
) -> str:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    form = (
        f"({columns}) USING parquet PARTITIONED BY (`{LAYOUT_COLUMN}`) CLUSTERED BY (`{key}`) "
        f"SORTED BY ({', '.join(f'`{name}`' for name in cluster)}) INTO {buckets} BUCKETS"
    )
    digest = hashlib.md5(f"{path} {form}".encode()).hexdigest()
    name = f"{scratch_database(spark)}.buckets_{digest}"
    # Partitions are found as folders, so that emptied ones need not be known to the catalog.
    with settings(spark, {_MANAGED: "false"}):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {form} LOCATION '{path}'")
    return name


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, key: str, cluster: Sequence[str]
) -> DataFrame | None:
    """The table at ``path`` under ``schema``, whose last column is the layout column, with its
    buckets; None if it has none."""
    buckets = bucket_count(spark, path)
    if buckets is None:
        return None
    name = _declare(spark, path, schema, key, cluster, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _insert(
    df: DataFrame, path: str, key: str, cluster: Sequence[str], buckets: int, mode: str
) -> None:
    name = _declare(df.sparkSession, path, df.schema, key, cluster, buckets)
    # Spark lists the table's folders again after an insert: in one job, however many there are.
    changed = {_OVERWRITE_MODE: mode, _LISTED_BY_DRIVER: "1"} | RELEASE_SHUFFLES
    with settings(df.sparkSession, changed):
        df.write.mode("overwrite").insertInto(name)


def write_buckets(
    df: DataFrame, path: str, key: str, cluster: Sequence[str], buckets: int
) -> None:
    """Replace the table at ``path``.  ``df``, with the layout column as its last, should come out
    of a shuffle by key (``dealt_into``): otherwise every task writes files of its own."""
    _insert(df, path, key, cluster, buckets, "static")
    write_state(df.sparkSession, _mark(path), str(buckets), reset=True)


def overwrite_partitions(
    df: DataFrame, path: str, key: str, cluster: Sequence[str], buckets: int
) -> None:
    """Replace the partitions of which ``df`` holds rows.  They are written aside first, so ``df`` may
    read the table."""
    _insert(df, path, key, cluster, buckets, "dynamic")
