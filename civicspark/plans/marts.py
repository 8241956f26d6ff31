"""The three marts.

All of them aggregate before they join, so a request type, ZIP code or missing value that
holds a large share of the rows is folded up inside the map tasks and never shuffled whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark import functions as fn
from civicspark.operators.joins import keep_keys, with_income
from civicspark.operators.ranking import most_frequent, top_k
from civicspark.plans.staging import positive_income

PLACE_MONTH = ["complaint_type", "city", "borough", "created_month"]
ZIP_GRAIN = [*PLACE_MONTH, "hour_of_day", "incident_zip"]


def agency_efficiency(staged: DataFrame) -> DataFrame:
    """Per month, place and agency: cases, closed cases, resolution days, deadline days."""
    closed = fn.is_closed(F.col("status"))
    month = fn.month_of(F.col("created_date")).alias("created_month")
    return staged.groupBy(month, "borough", "city", "agency", "agency_name").agg(
        F.count("unique_key").alias("total_cases"),
        fn.count_where(closed).alias("total_cases_closed"),
        fn.sum_where(closed, F.col("resolution_time_days")).alias("total_resolution_days"),
        F.sum("SLA_days").alias("total_sla_days"),
    )


def income_resolution(staged: DataFrame, income: DataFrame) -> DataFrame:
    """Per month, ZIP code and place: the same measures beside the ZIP code's median income."""
    month = fn.month_of(F.col("created_date")).alias("created_month")
    zip_code = F.col("incident_zip").alias("zip_code")
    measures = staged.groupBy(month, zip_code, "borough", "city").agg(
        F.count("unique_key").alias("total_complaints"),
        fn.count_where(fn.is_closed(F.col("status"))).alias("closed_complaints"),
        F.sum("resolution_time_days").alias("total_resolution_time"),
        F.count("due_date").alias("total_due_date"),
        F.sum("SLA_days").alias("total_sla_days"),
    )
    return with_zip_income(measures, income)


def with_zip_income(measures: DataFrame, income: DataFrame) -> DataFrame:
    """Measures per ZIP code beside its median income; ZIP codes without a usable one are dropped."""
    return with_income(measures, positive_income(income), "zip_code").select(
        *measures.columns, "median_income"
    )


def zip_profile(staged: DataFrame) -> DataFrame:
    """Requests counted per type, place, month, hour of day and ZIP code."""
    return (
        staged.select(
            "complaint_type",
            "city",
            "borough",
            "incident_zip",
            "unique_key",
            fn.month_of(F.col("created_date")).alias("created_month"),
            F.hour("created_date").alias("hour_of_day"),
        )
        .groupBy(*ZIP_GRAIN)
        .agg(F.count("*").alias("n"), F.count("unique_key").alias("n_keyed"))
    )


def valued_profile(per_zip: DataFrame, income: DataFrame) -> DataFrame:
    """Those of the counted requests that come from ZIP codes with a usable income, folded to hours,
    with the sum of the incomes."""
    valued = with_income(per_zip, positive_income(income))
    return valued.groupBy(*PLACE_MONTH, "hour_of_day").agg(
        F.sum("n").alias("n"),
        F.sum("n_keyed").alias("n_keyed"),
        F.sum(F.col("n") * F.col("median_income")).alias("income_sum"),
    )


def hourly_profile(staged: DataFrame, income: DataFrame) -> DataFrame:
    """Requests from ZIP codes with a usable income, counted per type, place, month and hour
    of day, with the sum of the incomes.  One pass over the requests serves all of the
    hotspot mart."""
    return valued_profile(zip_profile(staged), income)


def monthly_profile(hourly: DataFrame) -> DataFrame:
    """The hourly counts folded to type, place and month, with the busiest hour of day."""
    return hourly.groupBy(*PLACE_MONTH).agg(
        F.sum("n_keyed").alias("total_complaints"),
        (F.sum("income_sum") / F.sum("n")).alias("avg_income_of_reporters"),
        most_frequent("hour_of_day", "n").alias("busiest_hour"),
        F.sum("n").alias("n"),
    )


def complaint_hotspots(staged: DataFrame, income: DataFrame, k: int = 5) -> DataFrame:
    """For the ``k`` most frequent request types: requests, average income and most common hour
    per month and place.  Where city, borough or month is missing the hour is too, as a join on
    those columns would have it.

    Both the choice of the types and the result read the folded counts; their plans are equal up
    to there, so Spark scans and shuffles the requests once."""
    return hotspots_of(hourly_profile(staged, income), k)


def hotspots_of(hourly: DataFrame, k: int = 5) -> DataFrame:
    """The hotspot mart from the hourly counts."""
    monthly = monthly_profile(hourly)
    types = top_k(monthly, "complaint_type", k, weight=F.col("n"))
    placed = F.col("city").isNotNull() & F.col("borough").isNotNull()
    dated = F.col("created_month").isNotNull()
    return keep_keys(monthly, types).select(
        "created_month",
        "complaint_type",
        "city",
        "borough",
        "total_complaints",
        "avg_income_of_reporters",
        F.when(placed & dated, F.col("busiest_hour")).alias("most_common_hour_of_day"),
    )
