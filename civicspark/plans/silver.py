"""Raw records to Silver, and the cleaned income table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark import functions as fn
from civicspark.operators.dedup import dedup_exact
from civicspark.schemas import INCOME_NAMES, SILVER_INCOME


def with_resolution_days(df: DataFrame) -> DataFrame:
    days = fn.resolution_days(F.col("status"), F.col("closed_date"), F.col("created_date"))
    return df.withColumn("resolution_time_days", days)


def with_sla_days(df: DataFrame) -> DataFrame:
    return df.withColumn("SLA_days", fn.sla_days(F.col("due_date"), F.col("created_date")))


def with_ingest_stamp(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Stamp the rows with the instant of the run (now, when none is given) and its date."""
    if at is None:
        at = F.current_timestamp()
    stamp = at if isinstance(at, Column) else F.lit(at).cast("timestamp")
    return df.withColumn("ingest_timestamp", stamp).withColumn("ingest_date", fn.ingest_date(stamp))


def derive(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    return with_ingest_stamp(with_sla_days(with_resolution_days(df)), at)


def silver_complaints(raw: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """One run's raw records, exact duplicates removed, with day counts and ingest stamp."""
    return derive(dedup_exact(raw), at)


def rename_income(raw: DataFrame) -> DataFrame:
    """Give the census columns their names; a column that is missing is passed over."""
    return raw.withColumnsRenamed(INCOME_NAMES)


def clean_income(df: DataFrame) -> DataFrame:
    return df.withColumn("median_income", fn.income_amount(F.col("median_income")))


def silver_income(raw: DataFrame) -> DataFrame:
    return clean_income(rename_income(raw)).select(*SILVER_INCOME.names)
