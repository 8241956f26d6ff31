from __future__ import annotations

import os
import random
from datetime import date

import pytest
from helpers import as_set, at
from pyspark.sql import functions as F

from civicspark.operators import dedup, joins, ranking, upsert
from civicspark.operators.upsert import merge_into, merge_upsert
from civicspark.sinks.tables import LAYOUT_COLUMN, write_layout

ROWS = "unique_key string, updated_at timestamp, created_date timestamp, status string"
PLACES = "borough string, complaint_type string, incident_zip string"


def versions(spark, rows):
    return spark.createDataFrame(
        [(k, at(u), c and at(c), s, "b", "t", "z") for k, u, c, s in rows], f"{ROWS}, {PLACES}"
    )


def test_exact_dedup_compares_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, None)], "a int, b string")
    assert as_set(dedup.dedup_exact(df)) == {(1, None), (1, "a"), (2, None)}


def test_latest_version_ties_and_null_keys(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "x"),
            ("a", 3, "y"),
            ("a", 3, "z"),
            ("b", None, "x"),
            ("b", 0, "w"),
            (None, 1, "p"),
            (None, 2, "q"),
        ],
        "k string, u int, t string",
    )
    assert as_set(dedup.latest_per_key(df, "k", "u")) == {("a", 3, "z"), ("b", 0, "w"), (None, 2, "q")}


def test_top_k_counts_null_as_a_key_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [(t,) for t in ["b"] * 3 + ["a"] * 3 + [None] * 4 + ["c"] * 2 + ["d"]], "t string"
    )
    top = ranking.top_k(df, "t", 3)
    assert [r.t for r in top.collect()] == [None, "a", "b"]
    assert as_set(joins.keep_keys(df, top).groupBy("t").count()) == {("a", 3), ("b", 3)}


def test_modal_value_takes_the_lowest_on_ties(spark):
    df = spark.createDataFrame(
        [("x", 9), ("x", 9), ("x", 4), ("x", 4), ("x", 1), ("y", None), ("y", 23), (None, 5)],
        "g string, h int",
    )
    assert as_set(ranking.modal_value(df, ["g"], "h", "mode")) == {("x", 4), ("y", 23), (None, 5)}


def test_left_join_does_not_match_nulls(spark):
    left = spark.createDataFrame([("a", "b", 1), (None, "b", 2)], "x string, y string, n int")
    right = spark.createDataFrame([("a", "b", 7), (None, "b", 8)], "x string, y string, h int")
    assert as_set(joins.left_join(left, right, ["x", "y"])) == {("a", "b", 1, 7), (None, "b", 2, None)}


def test_income_join_drops_rows_without_income_and_fans_out_on_repeats(spark):
    rows = spark.createDataFrame([("1", 5), ("2", 6), (None, 7)], "incident_zip string, n int")
    income = spark.createDataFrame([("1", 10), ("1", 20), ("3", 5)], "zip_code string, median_income int")
    assert as_set(joins.with_income(rows, income)) == {("1", 5, 10), ("1", 5, 20)}


MERGES = {
    "first": [("a", "2025-01-01", "2025-01-01", "open"), ("b", "2025-01-02", "2025-01-01", "open")],
    "second": [
        ("a", "2025-01-05", "2025-01-01", "closed"),
        ("a", "2025-01-04", "2025-01-01", "pending"),
        ("b", "2024-12-31", "2025-01-01", "older"),
        ("c", "2025-01-05", "2025-01-03", "open"),
    ],
}


@pytest.mark.parametrize(("newer_only", "status_of_b"), [(False, "older"), (True, "open")])
def test_merge_replaces_and_inserts(spark, newer_only, status_of_b):
    target, batch = (versions(spark, MERGES[name]) for name in ("first", "second"))
    merged = merge_upsert(target, batch, "unique_key", "updated_at", newer_only=newer_only)
    assert {(r.unique_key, r.status) for r in merged.collect()} == {
        ("a", "closed"),
        ("b", status_of_b),
        ("c", "open"),
    }
    assert merged.columns == target.columns


def stored(spark, path):
    rows = spark.read.parquet(path).select("unique_key", "status", LAYOUT_COLUMN)
    return as_set(rows)


def merge(spark, path, rows, **options):
    merge_into(spark, path, versions(spark, rows), "unique_key", "updated_at", **options)


def test_stored_merge_moves_rows_between_partitions(spark, folder):
    path = f"{folder}/staged"
    day = date.fromisoformat
    merge(spark, path, [("a", "2025-01-01", "2025-01-01", "open"), ("n", "2025-01-01", None, "open")])
    merge(
        spark,
        path,
        [
            ("a", "2025-01-02", "2025-02-02", "moved"),
            ("n", "2025-01-02", "2025-01-09", "dated"),
            ("m", "2025-01-02", None, "undated"),
        ],
    )
    wanted = {
        ("a", "moved", day("2025-02-02")),
        ("n", "dated", day("2025-01-09")),
        ("m", "undated", None),
    }
    assert stored(spark, path) == wanted
    merge(spark, path, [("m", "2025-01-03", "2025-01-09", "now dated")])
    assert stored(spark, path) == wanted - {("m", "undated", None)} | {("m", "now dated", day("2025-01-09"))}


def test_stored_merge_leaves_other_partitions_alone(spark, folder):
    path = f"{folder}/staged"
    merge(spark, path, [("a", "2025-01-01", "2025-01-01", "x"), ("b", "2025-01-01", "2025-01-02", "x")])
    before = sorted(os.listdir(f"{path}/{LAYOUT_COLUMN}=2025-01-01"))
    merge(spark, path, [("b", "2025-01-03", "2025-01-02", "y")])
    assert sorted(os.listdir(f"{path}/{LAYOUT_COLUMN}=2025-01-01")) == before
    merge(spark, path, [])
    assert len(stored(spark, path)) == 2


@pytest.mark.parametrize("granularity", ["day", "month"])
@pytest.mark.parametrize("newer_only", [False, True])
def test_stored_merge_agrees_with_a_dict(spark, folder, granularity, newer_only):
    dice, path, kept = random.Random(3), f"{folder}/staged", {}
    for batch in range(4):
        rows = [
            (f"k{dice.randint(0, 25)}", f"2025-01-{dice.randint(1, 28):02}",
             dice.choice([None, f"2025-0{dice.randint(1, 4)}-0{dice.randint(1, 3)}"]),
             f"{batch}-{n:02}")
            for n in range(15)
        ]
        newest = {}
        for row in sorted(rows, key=lambda r: (r[1], r[2] or "", r[3])):
            newest[row[0]] = row
        for key, row in newest.items():
            if not newer_only or key not in kept or row[1] >= kept[key][1]:
                kept[key] = row
        for _ in range(2):  # the same batch again changes nothing
            merge(spark, path, rows, granularity=granularity, newer_only=newer_only)
        found = spark.read.parquet(path).select("unique_key", "status")
        assert as_set(found) == {(k, r[3]) for k, r in kept.items()}


def test_a_merge_that_died_while_publishing_is_repeated(spark, folder, monkeypatch):
    path = f"{folder}/staged"
    merge(spark, path, [("a", "2025-01-01", "2025-01-01", "old"), ("b", "2025-01-01", "2025-01-02", "b")])
    batch = [("a", "2025-01-02", "2025-01-03", "new")]
    real = upsert.remove_folders

    def die(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(upsert, "remove_folders", die)
    with pytest.raises(RuntimeError):
        merge(spark, path, batch)
    monkeypatch.setattr(upsert, "remove_folders", real)
    merge(spark, path, batch)
    assert {(k, s) for k, s, _ in stored(spark, path)} == {("a", "new"), ("b", "b")}


def test_layout_is_partitioned_and_sorted_inside_files(spark, folder):
    dice = random.Random(5)
    rows = [
        (f"k{n}", at("2025-01-01"), at(f"2025-0{dice.randint(1, 3)}-05"), "s",
         dice.choice("ABC"), dice.choice("xyz"), str(dice.randint(0, 9)))
        for n in range(300)
    ]
    df = spark.createDataFrame(rows, f"{ROWS}, {PLACES}").repartition(7)
    write_layout(df, folder, granularity="month")
    back = spark.read.parquet(folder)
    assert back.count() == 300
    parts = {r[0].isoformat() for r in back.select(LAYOUT_COLUMN).distinct().collect()}
    assert parts == {"2025-01-01", "2025-02-01", "2025-03-01"}
    for part in parts:
        in_file = spark.read.parquet(f"{folder}/{LAYOUT_COLUMN}={part}").withColumn(
            "file", F.input_file_name()
        )
        by_file = {}
        for r in in_file.collect():
            by_file.setdefault(r.file, []).append((r.borough, r.complaint_type, r.incident_zip))
        assert all(rows == sorted(rows) for rows in by_file.values())


def test_a_rebuild_removes_old_partitions_in_any_overwrite_mode(spark, folder):
    path, mode = f"{folder}/staged", "spark.sql.sources.partitionOverwriteMode"
    write_layout(versions(spark, [("a", "2025-01-01", "2025-01-01", "x")]), path)
    spark.conf.set(mode, "dynamic")
    try:
        write_layout(versions(spark, [("b", "2025-01-01", "2025-02-01", "x")]), path)
    finally:
        spark.conf.unset(mode)
    assert {k for k, _, _ in stored(spark, path)} == {"b"}
