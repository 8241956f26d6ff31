"""Merge by key: as a DataFrame operation, and into a partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civicspark.operators.dedup import latest_per_key
from civicspark.operators.joins import split_matched
from civicspark.session import bytes_read, drop_staged, releasing, remove_folders, stage_table
from civicspark.sinks.buckets import (
    MOST_BYTES,
    bucket_count,
    buckets_for,
    dealt_into,
    overwrite_partitions,
    read_buckets,
    write_buckets,
)
from civicspark.sinks.keys import Places
from civicspark.sinks.tables import (
    CLUSTER_COLUMNS,
    LAYOUT_COLUMN,
    laid_out,
    with_layout_column,
)
from civicspark.sources.files import path_exists, read_if_present

SIGN = "sign"
_OFFERED = "__from_batch"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    newest: str,
    tie_break: Sequence[str] | None = None,
    newer_only: bool = False,
) -> DataFrame:
    """``target`` with the rows of ``batch`` merged in by key: matched rows are replaced, the
    others inserted.  Several versions of a key inside the batch count as their latest.

    As a merge does, a batch row replaces the target row even when it is older; ``newer_only``
    keeps whichever is newer.  ``target`` must hold each key once.  The batch may be read twice, so
    pass a stored one."""
    if newer_only:
        # In one order, so that the batch is shuffled once: the newest, of the equally new the batch's.
        if tie_break is None:
            tie_break = [name for name in batch.columns if name not in (key, newest)]
        held = target.withColumn(_OFFERED, F.lit(0))
        both = held.unionByName(batch.withColumn(_OFFERED, F.lit(1)))
        return latest_per_key(both, key, newest, [_OFFERED, *tie_break]).drop(_OFFERED)
    untouched, _ = split_matched(target, batch, key)
    return untouched.unionByName(latest_per_key(batch, key, newest, tie_break))


def _merge_latest(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    newest: str,
    newer_only: bool,
    hashed: bool = False,
) -> DataFrame:
    if newer_only:
        held = target.withColumn(_OFFERED, F.lit(0))
        both = held.unionByName(batch.withColumn(_OFFERED, F.lit(1)))
        return latest_per_key(both, key, newest, [_OFFERED]).drop(_OFFERED)
    untouched, _ = split_matched(target, batch, key, hashed)
    return untouched.unionByName(batch)


def signed_images(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    newest: str,
    newer_only: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """What a merge of ``batch`` into ``target`` takes away and puts in place: the replaced rows with
    ``sign`` -1 and those that replace them, or are new, with +1.  Sums over the merged table change
    by the signed sums over these.  Both sides hold each key once."""
    _, replaced = split_matched(target, batch, key, hashed)
    kept = _merge_latest(replaced, batch, key, newest, newer_only) if newer_only else batch
    old = replaced.withColumn(SIGN, F.lit(-1))
    return old.unionByName(kept.withColumn(SIGN, F.lit(1)))


def merge_into(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    newest: str,
    tie_break: Sequence[str] | None = None,
    newer_only: bool = False,
    instant: str = "created_date",
    granularity: str = "day",
    cluster: Sequence[str] = CLUSTER_COLUMNS,
    changes: str | None = None,
    places: Places | None = None,
    merged: Callable[[DataFrame], None] | None = None,
    buckets: int | None = None,
) -> None:
    """Merge ``batch`` into the laid-out Parquet table at ``path``, creating it if need be.
    ``changes`` names a folder that gets the ``signed_images`` before the table is changed, ``places``
    says in which partitions the keys of a batch lie, without which the table's keys are scanned,
    and ``merged`` gets the stored batch when it has been merged.  A table that is created gets as
    many ``buckets``, or as many as the files need that the batch is read from.

    Only partitions that receive batch rows, or hold an older version of a batch key, are
    rewritten; a changed creation date thus moves a row.  Merging the same batch again changes
    nothing, so a run that died half-way is simply repeated.  Rows without a key cannot be
    merged and must be set aside before."""
    newest_batch = latest_per_key(batch, key, newest, tie_break)
    placed = with_layout_column(newest_batch, instant, granularity)
    if not path_exists(spark, path):
        buckets = buckets or buckets_for(batch)
        with dealt_into(placed, buckets):
            write_buckets(placed, path, key, cluster, buckets)
        return
    buckets = bucket_count(spark, path)
    with dealt_into(placed, buckets):
        name = stage_table(placed, "batch", key, buckets)
    stored = spark.table(name)
    merge_stored(spark, path, stored, key, newest, newer_only, cluster, changes, places)
    if merged:
        merged(stored)
    drop_staged(spark, name)


def merge_stored(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    newest: str,
    newer_only: bool = False,
    cluster: Sequence[str] = CLUSTER_COLUMNS,
    changes: str | None = None,
    places: Places | None = None,
) -> None:
    """As ``merge_into`` for a stored batch that holds each key once and has the layout column."""
    target = read_if_present(spark, path, batch.schema)
    if target is None:
        laid_out(batch, cluster).write.partitionBy(LAYOUT_COLUMN).parquet(path)
        return
    buckets = bucket_count(spark, path)
    if buckets:
        target = read_buckets(spark, path, batch.schema, key, cluster)
    if places:
        held = places(batch)
    else:
        # Only the key and the partition value are read to find the partitions concerned.
        _, replaced = split_matched(target.select(key, LAYOUT_COLUMN), batch, key)
        held = replaced.select(LAYOUT_COLUMN)
    touched, left = _partition_values(held, batch)
    if not touched:
        return
    if newer_only:  # rows of the batch may be passed over
        left = touched
    affected = target.filter(in_partitions(LAYOUT_COLUMN, touched))
    hashed = bool(buckets) and bytes_read(batch) <= buckets * MOST_BYTES
    if changes:
        # An image is gone from the table once it is merged, so it is stored before.
        images = signed_images(affected, batch, key, newest, newer_only, hashed)
        with releasing(images):
            images.write.mode("overwrite").parquet(changes)
    # The new partitions are written aside and then moved in place, so the merge may read the old.
    merged = _merge_latest(affected, batch, key, newest, newer_only, hashed)
    filled = Observation()
    if left:
        value = F.col(LAYOUT_COLUMN)
        merged = merged.observe(
            filled,
            F.collect_set(F.when(in_partitions(LAYOUT_COLUMN, left), value.cast("string"))).alias(
                "parts"
            ),
            F.count_if(value.isNull()).alias("undated"),
        )
    if buckets:
        overwrite_partitions(merged, path, key, cluster, buckets)
    else:
        writer = laid_out(merged, cluster).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
        with releasing(merged):
            writer.partitionBy(LAYOUT_COLUMN).parquet(path)
    # A dynamic overwrite leaves a partition all of whose rows moved away as it was.
    if left:
        kept = set(filled.get["parts"]) | ({NULL_PARTITION} if filled.get["undated"] else set())
        folders = [NULL_PARTITION if value is None else value.isoformat() for value in left]
        emptied = [f"{path}/{LAYOUT_COLUMN}={name}" for name in folders if name not in kept]
        remove_folders(spark, *emptied)


def _partition_values(held: DataFrame, batch: DataFrame) -> tuple[list, list]:
    """The partitions that a merge touches, and those of them that get no row of the batch, which alone
    can be emptied by it; at most one per day (month, year) of data."""
    both = held.select(LAYOUT_COLUMN, F.lit(True).alias("only_held")).union(
        batch.select(LAYOUT_COLUMN, F.lit(False))
    )
    rows = both.groupBy(LAYOUT_COLUMN).agg(F.bool_and("only_held")).collect()
    return [value for value, _ in rows], [value for value, only_held in rows if only_held]


def in_partitions(name: str, values: Sequence) -> Column:
    """Whether the partition column has one of the values, null among them."""
    column = F.col(name)
    known = [value for value in values if value is not None]
    wanted = column.isin(known)
    return wanted | column.isNull() if len(known) < len(values) else wanted
