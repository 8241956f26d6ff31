"""Ordered slices addressed by value instead of by offset."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.schemas import PAGE_SIZE
from civicspark.session import stage_table


def _order(df: DataFrame, order: Sequence[str]) -> list[Column]:
    types = dict(df.dtypes)
    unfit = [n for n in order if not types[n].startswith("timestamp") and types[n] != "string"]
    if unfit or not types[order[0]].startswith("timestamp"):
        raise TypeError(f"cannot slice in the order of {[(n, types[n]) for n in order]}")
    return [F.col(f"`{name}`") for name in order]


def slice_after(
    df: DataFrame, order: Sequence[str], last: Sequence[Any] | None, size: int = PAGE_SIZE
) -> DataFrame:
    """The next ``size`` rows in ``order`` after the position ``last`` (one value per order
    column; None for the first slice).  Addressing rows by value neither skips nor repeats any
    when others are added, as a deep offset would.

    Order columns are timestamps or strings, the first one a timestamp; rows without that are
    in no slice.  Together they must tell rows apart.  Rows are counted per hour, and only those up
    to the end of the hour in which the slice is full are sorted; that hour is a subquery of the
    plan, so building the slice runs nothing."""
    columns = _order(df, order)
    types = dict(df.dtypes)
    rest = df.filter(columns[0].isNotNull())
    if last is not None:
        position = [F.lit(v).cast(types[n]) for n, v in zip(order, last, strict=True)]
        rest = rest.filter(
            (columns[0] >= position[0]) & (F.struct(*columns) > F.struct(*position))
        )
    hour = F.date_trunc("hour", columns[0])
    held = rest.groupBy(hour.alias("hour")).agg(F.count("*").alias("n"))
    before = Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    reached = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last_hour = reached.filter(F.col("before") < size).select(F.max("hour")).scalar()
    return rest.filter(hour <= last_hour).orderBy(*columns).limit(size)


def number_slices(df: DataFrame, order: Sequence[str], size: int = PAGE_SIZE) -> DataFrame:
    """All rows with the number of their slice (``page``, from 0), as paging through the table
    would have them: one sort of the whole, written once, instead of a pass per slice."""
    columns = _order(df, order)
    rows = df.filter(columns[0].isNotNull())
    ranged = rows.repartitionByRange(*columns).withColumn("__range", F.spark_partition_id())
    stored = df.sparkSession.table(stage_table(ranged, "slices"))
    counts = stored.groupBy("__range").agg(F.count("*").alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(*columns))
    placed = stored.withColumn("__rank", rank).join(offsets, "__range")
    page = F.floor((F.col("__before") + F.col("__rank") - 1) / size)
    return placed.select(*[f"`{c}`" for c in df.columns], page.alias("page"))


def walk_slices(
    df: DataFrame, order: Sequence[str], size: int = PAGE_SIZE
) -> Iterator[DataFrame]:
    """All slices one after the other.  Only each slice's end reaches the driver.  To take the
    whole of a large table, number its slices instead."""
    last = None
    while True:
        page = slice_after(df, order, last, size)
        ends = F.struct(*[F.col(f"`{name}`") for name in order])
        count, end = page.agg(F.count("*"), F.max(ends)).first()
        if count:
            yield page
        if count < size:
            return
        last = tuple(end)
