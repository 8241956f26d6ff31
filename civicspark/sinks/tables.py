"""Parquet and JSON-lines sinks, the clustered layout, and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.session import releasing
from civicspark.sources.extract import union_pages

# The layout of the staged table.
CLUSTER_COLUMNS = ("borough", "complaint_type", "incident_zip")
LAYOUT_COLUMN = "created_part"
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def append_silver(df: DataFrame, path: str) -> None:
    """Append one run to the Silver folder, one partition per ingest date."""
    with releasing(df):
        df.write.mode("append").partitionBy("ingest_date").parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace the whole table; ``df`` must not read from ``path``."""
    with releasing(df):
        df.write.mode("overwrite").parquet(path)


def write_ndjson(
    pages: Sequence[DataFrame],
    path: str,
    run: str,
    compression: str = "none",
    fast: bool = False,
) -> str:
    """Write the pages of one run as JSON lines under ``path``, in a folder named by the run.

    The pages' columns may differ; writing the same run again replaces it.  Times keep their
    microseconds, by which versions are told apart.  ``gzip`` takes a
    ninth of the space, but such files are read by one task each, and most of the
    time in writing them goes into it; ``fast`` takes half the time in all and two fifths more space."""
    target = f"{path}/data_{run}.ndjson"
    rows = union_pages(pages)
    writer = rows.write.mode("overwrite")
    if fast:
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    with releasing(rows):
        writer.json(target, compression=compression, timestampFormat=INSTANT_FORMAT)
    return target


def with_layout_column(
    df: DataFrame, instant: str = "created_date", granularity: str = "day"
) -> DataFrame:
    """Add the partition column: the day (or month, year) an instant falls in."""
    return df.withColumn(LAYOUT_COLUMN, F.to_date(F.date_trunc(granularity, F.col(instant))))


def laid_out(df: DataFrame, cluster: Sequence[str] = CLUSTER_COLUMNS) -> DataFrame:
    """Rows brought together by partition value and sorted by the cluster columns inside it.

    The rebalance hint lets adaptive execution merge small partitions and split a partition
    value that holds too many rows, so neither tiny files nor one huge task result."""
    return df.hint("rebalance", LAYOUT_COLUMN).sortWithinPartitions(LAYOUT_COLUMN, *cluster)


def write_layout(
    df: DataFrame,
    path: str,
    instant: str = "created_date",
    granularity: str = "day",
    cluster: Sequence[str] = CLUSTER_COLUMNS,
) -> None:
    """Replace the table at ``path`` in the partitioned and clustered layout."""
    placed = laid_out(with_layout_column(df, instant, granularity), cluster)
    # Static, whatever the session says: a rebuild must also remove partitions now empty.
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with releasing(placed):
        writer.partitionBy(LAYOUT_COLUMN).parquet(path)


def register_mart(name: str, df: DataFrame) -> DataFrame:
    """Publish a table or mart as a view of this session."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
