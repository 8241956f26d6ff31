from __future__ import annotations

from datetime import date

import pytest
from helpers import as_set, at, silver_frame

from civicspark import schemas
from civicspark.operators import quality
from civicspark.plans import dashboard, marts
from civicspark.plans import silver as silver_plan
from civicspark.plans.staging import (
    keyless,
    positive_income,
    since_last_ingest,
    stage_complaints,
    staged_latest,
)

INCOME = "zip_code string, median_income int"


def staged(spark, rows):
    return stage_complaints(silver_plan.with_sla_days(silver_plan.with_resolution_days(
        silver_frame(spark, rows).drop("resolution_time_days", "SLA_days"))))


def test_silver_removes_exact_copies_and_stamps_the_run(spark):
    row = {"unique_key": "1", "status": "Closed", "created_date": "2025-01-01T08:00:00",
           "closed_date": "2025-01-04T07:00:00", "due_date": "2025-01-02T00:00:00"}
    raw = silver_frame(spark, [row, row, {**row, "city": "x"}]).select(
        *[f"`{n}`" for n in schemas.RAW_COMPLAINT.names]
    )
    out = silver_plan.silver_complaints(raw, at("2025-02-03T23:59:59")).collect()
    assert len(out) == 2
    assert {(r.resolution_time_days, r.SLA_days, r.ingest_date) for r in out} == {
        (3, 1, date(2025, 2, 3))
    }
    now = silver_plan.silver_complaints(raw)
    assert sorted(now.columns) == sorted(schemas.SILVER_COMPLAINT.names)


def test_income_is_renamed_and_cleaned_even_with_a_column_missing(spark):
    raw = spark.createDataFrame(
        [("ZCTA 1", "-666666666", "00001"), ("ZCTA 2", "61000", "00002"), ("ZCTA 3", "x", "00003")],
        "NAME string, S1901_C01_012E string, `zip code tabulation area` string",
    )
    assert as_set(silver_plan.silver_income(raw)) == {
        ("ZCTA 1", 0, "00001"), ("ZCTA 2", 61000, "00002"), ("ZCTA 3", None, "00003")
    }
    assert silver_plan.rename_income(raw.drop("NAME")).columns == ["median_income", "zip_code"]


def test_positive_income_drops_null_zero_and_negative(spark):
    income = spark.createDataFrame([("1", None), ("2", 0), ("3", -4), ("4", 9)], INCOME)
    assert as_set(positive_income(income)) == {("4", 9)}


def test_staging_keeps_its_columns_in_order(spark):
    out = staged(spark, [{"unique_key": "1", "status": "\tClosed ", "city": " queens ",
                          ":updated_at": "2025-01-01T00:00:00"}])
    assert out.columns == schemas.STAGED_COLUMNS and len(out.columns) == 26
    row = out.first()
    assert (row.status, row.city, row.updated_at) == ("closed", "QUEENS", at("2025-01-01T00:00:00"))


def test_incremental_slice_includes_the_last_day_and_survives_an_empty_target(spark):
    silver = silver_frame(spark, [
        {"unique_key": k, "ingest_date": d}
        for k, d in [("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-01-03")]
    ])
    target = stage_complaints(silver.filter("ingest_date <= '2025-01-02'"))
    keys = lambda df: {r.unique_key for r in df.collect()}
    assert keys(since_last_ingest(silver, target)) == {"b", "c"}
    assert keys(since_last_ingest(silver, target.limit(0))) == {"a", "b", "c"}
    assert keys(since_last_ingest(silver, None)) == {"a", "b", "c"}


def test_rows_without_a_key_are_set_aside(spark):
    silver = silver_frame(spark, [{"unique_key": "1"}, {"status": "Open"}])
    assert [r.status for r in keyless(silver).collect()] == ["Open"]


CASES = [
    # key, raw status, created, closed, due, zip, city, borough, type, agency
    ("1", "Closed", "2025-01-05T10:00:00", "2025-01-08T00:00:00", "2025-01-07T00:00:00", "1", "a", "B", "noise", "X"),
    ("2", " closed ", "2025-01-06T10:30:00", "2025-01-09T00:00:00", None, "1", "a", "B", "noise", "X"),
    ("3", "Open", "2025-01-07T11:00:00", None, None, "2", "a", "B", "noise", "X"),
    ("4", "Closed", "2025-01-07T12:00:00", "2025-01-01T00:00:00", None, "1", None, "B", "noise", "X"),
    ("5", "Open", "2025-02-07T09:00:00", None, None, "3", "a", "B", "heat", "Y"),
    ("6", "Open", "2025-02-07T09:00:00", None, None, None, "a", "B", "heat", "Y"),
    ("7", "Open", "2025-02-07T09:00:00", None, None, "1", "a", None, None, "Y"),
    ("8", "Open", "2025-02-07T09:00:00", None, None, "2", "a", None, None, "Y"),
]


@pytest.fixture
def cases(spark):
    names = "unique_key status created_date closed_date due_date incident_zip city borough complaint_type agency"
    return staged(spark, [dict(zip(names.split(), case)) for case in CASES])


@pytest.fixture
def income(spark):
    return spark.createDataFrame([("1", 100), ("2", 400), ("3", 0), ("4", 7)], INCOME)


def test_agency_mart(cases):
    rows = marts.agency_efficiency(cases).collect()
    jan, feb = at("2025-01-01T00:00:00"), at("2025-02-01T00:00:00")
    assert {
        (r.created_month, r.borough, r.city, r.agency): (
            r.total_cases, r.total_cases_closed, r.total_resolution_days, r.total_sla_days)
        for r in rows
    } == {
        # A padded status counts as closed, but has no resolution days; with none at all the
        # closed sum still counts the open ones as 0.
        (jan, "B", "A", "X"): (3, 2, 3, 2),
        (jan, "B", None, "X"): (1, 1, -6, None),
        (feb, "B", "A", "Y"): (2, 0, 0, None),
        (feb, None, "A", "Y"): (2, 0, 0, None),
    }


def test_income_mart(cases, income):
    rows = marts.income_resolution(cases, income).collect()
    assert {
        (r.created_month.month, r.zip_code, r.borough, r.city): (
            r.total_complaints, r.closed_complaints, r.total_resolution_time,
            r.total_due_date, r.total_sla_days, r.median_income)
        for r in rows
    } == {
        (1, "1", "B", "A"): (2, 2, 3, 1, 2, 100),
        (1, "1", "B", None): (1, 1, -6, 0, None, 100),
        (1, "2", "B", "A"): (1, 0, None, 0, None, 400),
        (2, "1", None, "A"): (1, 0, None, 0, None, 100),
        (2, "2", None, "A"): (1, 0, None, 0, None, 400),
    }


def test_hotspot_mart(cases, income):
    def rows(k):
        return {
            (r.created_month.month, r.complaint_type, r.city, r.borough): (
                r.total_complaints, r.avg_income_of_reporters, r.most_common_hour_of_day)
            for r in marts.complaint_hotspots(cases, income, k).collect()
        }

    noise = {
        (1, "noise", "A", "B"): (3, 200.0, 10),
        (1, "noise", None, "B"): (1, 100.0, None),
    }
    # The missing type has the second most requests: it takes a place, but is never shown.
    assert rows(1) == rows(2) == noise
    assert rows(5) == noise


def test_repeated_incomes_fan_out(spark, cases):
    doubled = spark.createDataFrame([("1", 100), ("1", 300)], INCOME)
    assert marts.income_resolution(cases, doubled).count() == 6
    row = marts.complaint_hotspots(cases, doubled, 1).filter("city = 'A'").first()
    assert (row.total_complaints, row.avg_income_of_reporters) == (4, 200.0)


def test_charts(spark, cases, income):
    agency = marts.agency_efficiency(cases)
    ranking = dashboard.agency_ranking(agency).collect()
    assert [(r.agency, r.avg_resolution_days) for r in ranking] == [("X", -1.0), ("Y", None)]
    boroughs = {r.borough: r.avg_resolution_days
                for r in dashboard.avg_resolution_by_borough(agency).collect()}
    assert boroughs == {"B": -1.0, None: None}
    types = dashboard.types_by_borough(marts.complaint_hotspots(cases, income))
    assert as_set(types) == {("noise", "B", 4)}
    assert dashboard.income_scatter(marts.income_resolution(cases, income)).count() == 0

    points = spark.createDataFrame(
        [("1", 3.0, 10), ("2", 5.0, 20), ("3", 7.0, 30)],
        "zip_code string, avg_resolution_days double, median_income int")
    line = dashboard.income_trendline(points).first()
    assert (line.points, round(line.slope, 9), round(line.intercept, 9), round(line.r2, 9)) == (
        3, 0.2, 1.0, 1.0)


def test_checks_return_the_failing_rows(spark):
    rows = staged(spark, [
        {"unique_key": "1", "status": " CLOSED "},
        {"unique_key": "1", "status": "In Progress"},
        {"unique_key": "2", "status": "Reopened"},
        {"unique_key": None, "status": None},
        {"unique_key": None, "status": "open", "incident_zip": "9"},
    ])
    income = spark.createDataFrame([("1", -5), ("1", 4), ("2", 3), (None, 1)], INCOME)
    assert as_set(quality.check_unique(rows, "unique_key")) == {("1", 2)}
    assert quality.check_not_null(rows, "unique_key").count() == 2
    assert as_set(quality.check_accepted(rows, "status")) == {("reopened", 1)}
    assert as_set(quality.check_negative_income(income)) == {("1", -1)}
    assert as_set(quality.check_relationship(rows, "incident_zip", income, "zip_code")) == {("9", 1)}
    assert as_set(quality.check_income_key(income)) == {("1", 2), (None, 1)}
    summary = quality.staging_summary(rows)
    assert summary.first().asDict() == {"unique": 1, "not_null": 2, "accepted_values": 1}
    with pytest.raises(quality.QualityError, match="not_null"):
        quality.gate(summary)


def test_the_gate_lets_clean_and_empty_tables_pass(spark):
    rows = staged(spark, [{"unique_key": "1", "status": "Open"}])
    clean = {"unique": 0, "not_null": 0, "accepted_values": 0}
    assert quality.gate(quality.staging_summary(rows)) == clean
    assert quality.gate(quality.staging_summary(rows.limit(0))) == clean


def test_latest_version_is_the_same_whatever_the_row_order(spark):
    rows = [{"unique_key": "1", "status": s, ":updated_at": "2025-01-01T00:00:00"} for s in "abc"]
    for order in (rows, rows[::-1]):
        silver = silver_frame(spark, order)
        assert [r.status for r in staged_latest(silver).collect()] == ["c"]
