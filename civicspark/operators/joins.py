"""Join shapes.  None forces a broadcast: Spark broadcasts a side whose size it has checked
against its threshold, and otherwise sorts and merges, splitting hot keys at run time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is among ``keys``; a null key never matches."""
    return df.join(keys, keys.columns, "left_semi")


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left outer join by plain equality: rows with a null key keep nulls from the right."""
    return left.join(right, list(keys), "left")


def with_income(df: DataFrame, income: DataFrame, zip_code: str = "incident_zip") -> DataFrame:
    """Inner join to the positive incomes; rows without one are dropped."""
    return df.join(
        income.select(F.col("zip_code").alias(zip_code), "median_income"), zip_code, "inner"
    )


def split_matched(
    target: DataFrame, batch: DataFrame, key: str, hashed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Target rows a batch leaves alone, and target rows it replaces.  With ``hashed`` the batch's keys
    are held in hash tables, so the target's rows need not be sorted: for a batch that lies in the
    target's buckets, few enough keys in each, every key once."""
    keys = batch.select(key)
    if hashed:
        keys = keys.hint("shuffle_hash")
    return target.join(keys, key, "left_anti"), target.join(keys, key, "left_semi")
