from __future__ import annotations

import pytest
from helpers import at
from pyspark.sql import functions as F

from civicspark import functions as fn


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "status"),
    [
        ("Closed", "closed"),
        (" closed ", "closed"),
        ("\tIn Progress\n", "in progress"),
        (" Open　", "open"),
        ("  ", ""),
        (None, None),
    ],
)
def test_status_is_lowered_and_stripped_of_any_white_space(spark, text, status):
    assert one(spark, fn.normal_status(F.col("s").cast("string")), s=text) == status


def test_city_keeps_inner_spaces(spark):
    assert one(spark, fn.normal_city(F.col("c")), c=" far  rockaway ") == "FAR  ROCKAWAY"


@pytest.mark.parametrize(
    ("text", "amount"),
    [
        ("-666666666", 0),
        ("-666666666.0", 0),
        ("52000", 52000),
        (" 52000 ", 52000),
        ("52000.9", 52000),
        ("-5", -5),
        ("0", 0),
        ("n/a", None),
        ("", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_income_text(spark, text, amount):
    assert one(spark, fn.income_amount(F.col("t").cast("string")), t=text) == amount


@pytest.mark.parametrize(
    ("status", "closed", "days"),
    [
        ("Closed", "2025-01-03T00:00:01", 2),
        ("Closed", "2025-01-01T00:00:00", 0),
        ("Closed", "2024-12-30T23:59:59", -2),
        ("Closed", None, None),
        ("closed", "2025-01-03T00:00:00", None),
        (" Closed ", "2025-01-03T00:00:00", None),
        (None, "2025-01-03T00:00:00", None),
    ],
)
def test_resolution_days_need_the_exact_status(spark, status, closed, days):
    column = fn.resolution_days(
        F.col("s").cast("string"), F.col("c").cast("timestamp"), F.col("o").cast("timestamp")
    )
    assert one(spark, column, s=status, c=closed, o="2025-01-01T23:00:00") == days


def test_sla_days_are_null_without_a_due_date(spark):
    column = fn.sla_days(F.col("d").cast("timestamp"), F.col("o").cast("timestamp"))
    assert one(spark, column, d="2025-02-01", o="2025-01-31T12:00:00") == 1
    assert one(spark, column, d=None, o="2025-01-31") is None


def test_run_stamp_and_month(spark):
    moment = F.col("t").cast("timestamp")
    assert one(spark, fn.run_stamp(moment), t="2025-03-04T05:06:07Z") == "20250304T050607Z"
    month = one(spark, fn.month_of(moment), t="2025-03-31T23:59:59Z")
    assert month == at("2025-03-01T00:00:00")


def test_average_of_nothing_closed_is_null(spark):
    rows = spark.createDataFrame([("a", 5, 0), ("b", 9, 2), ("b", 1, 2)], "k string, d int, n int")
    averages = rows.groupBy("k").agg(fn.average_days(F.col("d"), F.col("n")).alias("avg"))
    assert {r.k: r.avg for r in averages.collect()} == {"a": None, "b": 2.5}
