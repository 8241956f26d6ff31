"""Exact duplicates and latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__version_rank"


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column.  Copies collapse inside each map task first, so a row
    repeated very often does not travel through the shuffle."""
    return df.dropDuplicates()


def latest_per_key(
    df: DataFrame,
    key: str,
    newest: str,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``newest`` value per key; all null keys form one group.

    Ties go to the highest ``tie_break`` columns (by default all remaining ones, in order), so
    the result does not depend on row order.  Spark keeps at most one row per key and map task
    before the shuffle, so a key with very many versions does not end up in one task."""
    if tie_break is None:
        tie_break = [name for name in df.columns if name not in (key, newest)]
    order = [F.col(f"`{name}`").desc_nulls_last() for name in (newest, *tie_break)]
    window = Window.partitionBy(f"`{key}`").orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
