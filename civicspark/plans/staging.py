"""Silver to the staged tables the marts and checks read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark import functions as fn
from civicspark.operators.dedup import latest_per_key
from civicspark.schemas import STAGED_COLUMNS, SYSTEM_COLUMNS

KEY, UPDATED = "unique_key", "updated_at"


def stage_complaints(silver: DataFrame) -> DataFrame:
    """The staged columns, status and city normalised, system columns renamed."""
    return silver.withColumnsRenamed(SYSTEM_COLUMNS).select(
        *[
            {
                "status": fn.normal_status(F.col("status")),
                "city": fn.normal_city(F.col("city")),
            }.get(name, F.col(name)).alias(name)
            for name in STAGED_COLUMNS
        ]
    )


def staged_latest(silver: DataFrame, tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per request: its latest version."""
    return latest_per_key(stage_complaints(silver), KEY, UPDATED, tie_break)


def since_last_ingest(silver: DataFrame, staged: DataFrame | str | None) -> DataFrame:
    """Silver rows ingested on or after the newest ingest date that is staged: that of a table, or
    the date a run has stored.  All of them when nothing is staged.  The comparison prunes whole
    Silver partitions; a stored date spares the scan of the staged table."""
    if staged is None:
        return silver
    if isinstance(staged, str):
        return silver.filter(F.col("ingest_date") >= F.lit(staged).cast("date"))
    newest = staged.select(F.max("ingest_date")).scalar()
    beginning = F.lit("0001-01-01").cast("date")
    return silver.filter(F.col("ingest_date") >= F.coalesce(newest, beginning))


def keyless(silver: DataFrame) -> DataFrame:
    """Rows that cannot be merged because their key is missing."""
    return silver.filter(F.col(KEY).isNull())


def stage_income(silver_income: DataFrame) -> DataFrame:
    return silver_income.select("zip_code", "median_income")


def positive_income(staged_income: DataFrame) -> DataFrame:
    """Usable incomes: null, zero (no data) and negative ones are dropped."""
    return staged_income.filter(F.col("median_income") > 0)
