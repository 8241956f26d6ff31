"""Marts that follow the staged table by signed changes equal those built from all of it."""

from __future__ import annotations

import glob
import os
import random

import pytest
from helpers import silver_frame
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.operators import upsert
from civicspark.operators.upsert import SIGN, signed_images
from civicspark.plans import jobs, kept, marts
from civicspark.plans.staging import stage_complaints
from civicspark.session import bytes_read
from civicspark.sinks.tables import append_silver, overwrite_table


@pytest.fixture
def lake(spark, folder):
    where = jobs.Lake(folder)
    incomes = spark.createDataFrame(
        [("n", 50_000, "1"), ("n", 30_000, "2"), ("n", 0, "3"), ("n", None, "4")],
        schemas.SILVER_INCOME,
    )
    overwrite_table(incomes, where.silver_income)
    return where


def request(key, day, **values):
    row = {
        "unique_key": str(key),
        "status": "Open",
        "created_date": "2025-01-10T08:00:00",
        ":updated_at": f"2025-05-{day:02}T08:00:00",
        "ingest_date": f"2025-05-{day:02}",
        "complaint_type": "Noise",
        "borough": "B",
        "city": "C",
        "agency": "A",
        "incident_zip": "1",
    }
    return row | values


def merge(spark, lake, rows, **options):
    append_silver(silver_frame(spark, rows), lake.silver_complaints)
    jobs.build_staging(spark, lake, granularity="month", **options)


def rows_of(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=repr)


def check(spark, lake):
    """The stored marts against those of the whole staged table."""
    staged = jobs.staged_complaints(spark, lake)
    income = spark.read.schema(schemas.STAGED_INCOME).parquet(lake.staged_income)
    built = jobs.read_marts(spark, lake)
    wanted = {
        "fct_agency_efficiency": marts.agency_efficiency(staged),
        "fct_income_resolution": marts.income_resolution(staged, income),
        "fct_complaint_hotspots": marts.complaint_hotspots(staged, income),
    }
    for name, frame in wanted.items():
        assert dict(built[name].dtypes) == dict(frame.dtypes)
        assert rows_of(built[name]) == rows_of(frame), name
    return built


def some(rng, day, keys):
    months = [None, *(f"2025-0{m}-1{m}T0{h}:00:00" for m in (1, 2, 3) for h in (1, 8))]
    return [
        request(
            key,
            day,
            status=rng.choice(["Open", "Closed", " closed ", None]),
            created_date=rng.choice(months),
            complaint_type=rng.choice(["Noise", "Heat", "Trees", None]),
            borough=rng.choice(["B", None]),
            agency=rng.choice(["A", "Z"]),
            incident_zip=rng.choice(["1", "2", "3", "9", None]),
            resolution_time_days=rng.choice([None, 0, 3]),
            SLA_days=rng.choice([None, 5]),
            due_date=rng.choice([None, "2025-04-01T00:00:00"]),
        )
        for key in rng.sample(range(40), keys)
    ]


def test_marts_follow_every_merge(spark, lake):
    rng = random.Random(8)
    for day, keys in ((1, 30), (2, 12), (3, 1), (4, 20)):
        merge(spark, lake, some(rng, day, keys))
        jobs.build_marts(spark, lake)
        check(spark, lake)
    # several merges at once, then none
    merge(spark, lake, some(rng, 5, 10))
    merge(spark, lake, some(rng, 6, 10))
    jobs.build_marts(spark, lake)
    before = rows_of(check(spark, lake)["fct_agency_efficiency"])
    jobs.build_marts(spark, lake)
    assert rows_of(jobs.read_marts(spark, lake)["fct_agency_efficiency"]) == before


def test_a_batch_unseats_a_top_type_and_empties_a_month(spark, lake):
    kinds = ["T1", "T2", "T3", "T4", "T5", "T6"]
    first = [
        request(f"{kind}-{n}", 1, complaint_type=kind, created_date="2025-02-01T03:00:00")
        for k, kind in enumerate(kinds)
        for n in range(7 - k)
    ]
    merge(spark, lake, first)
    jobs.build_marts(spark, lake)
    assert "T6" not in {r[1] for r in rows_of(check(spark, lake)["fct_complaint_hotspots"])}
    # all of T1 turns into T6, in another month
    moved = [
        r | {":updated_at": "2025-05-02T08:00:00", "ingest_date": "2025-05-02",
             "complaint_type": "T6", "created_date": "2025-03-01T09:00:00"}
        for r in first
        if r["complaint_type"] == "T1"
    ]
    merge(spark, lake, moved)
    jobs.build_marts(spark, lake)
    found = check(spark, lake)["fct_complaint_hotspots"].collect()
    assert {r.complaint_type for r in found} == set(kinds) - {"T1"}


def test_untouched_months_and_the_staged_table_are_not_read(spark, lake, monkeypatch):
    merge(spark, lake, [
        request(n, 1, created_date=f"2025-0{1 + n % 4}-05T00:00:00") for n in range(20)
    ])
    jobs.build_marts(spark, lake)
    merge(spark, lake, [request(0, 2, agency="Z"), request(99, 2)])
    read = []
    advance = kept.advance

    def watched(*args):
        before = advance(*args)
        read.append((args[1], bytes_read(before)))

    def unread(*_):
        raise AssertionError("the staged table is read")

    monkeypatch.setattr(kept, "advance", watched)
    monkeypatch.setattr(jobs, "staged_complaints", unread)
    jobs.build_marts(spark, lake)
    assert len(read) == len(kept.ALL)
    for path, size in read:
        touched = glob.glob(f"{path}/generation=1/part=2025-01/*.parquet")
        assert size == sum(map(os.path.getsize, touched)) > 0
    monkeypatch.undo()
    check(spark, lake)


def test_rows_merged_again_touch_no_month(spark, lake):
    rows = [request(n, 1) for n in range(5)]
    merge(spark, lake, rows)
    jobs.build_marts(spark, lake)
    jobs.build_staging(spark, lake, granularity="month")  # the same slice once more
    jobs.build_marts(spark, lake)
    assert len(glob.glob(f"{lake.marts}/kept/{kept.AGENCY.name}/*/part=*")) == 1
    check(spark, lake)


def test_changed_months_of_all_marts_are_found_in_one_pass(spark):
    now = silver_frame(spark, [
        request(1, 1), request(2, 1, created_date="2025-02-10T08:00:00"),
        request(3, 1, created_date="2025-03-10T08:00:00"), request(4, 1, created_date=None),
    ])
    later = silver_frame(spark, [
        request(1, 2), request(2, 2, created_date="2025-02-10T08:00:00", agency="Z"),
        request(3, 2, created_date="2025-04-10T08:00:00"), request(4, 2, created_date=None, incident_zip=None),
    ])
    old, new = stage_complaints(now), stage_complaints(later)
    images = old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))
    found = {name: set(months) for name, months in kept.months_changed(images).items()}
    assert found == {
        "agency_efficiency": {"2025-02", "2025-03", "2025-04"},
        "income_resolution": {"2025-03", "2025-04", kept.NO_MONTH},
        "hour_histogram": {"2025-03", "2025-04", kept.NO_MONTH},
    }


def test_a_merge_that_died_is_finished_from_its_changes(spark, lake, monkeypatch):
    rng = random.Random(2)
    merge(spark, lake, some(rng, 1, 20))
    jobs.build_marts(spark, lake)

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert, "_merge_latest", dies)
    with pytest.raises(RuntimeError, match="lost"):
        merge(spark, lake, some(rng, 2, 20))
    monkeypatch.undo()
    # the changes are stored, the table is as it was, and more rows come in
    merge(spark, lake, some(rng, 3, 10))
    jobs.build_marts(spark, lake)
    check(spark, lake)


def test_marts_that_died_half_way_are_brought_up_again(spark, lake, monkeypatch):
    rng = random.Random(3)
    merge(spark, lake, some(rng, 1, 20))
    jobs.build_marts(spark, lake)
    before = rows_of(jobs.read_marts(spark, lake)["fct_agency_efficiency"])
    merge(spark, lake, some(rng, 2, 20))
    advance = kept.advance

    def dies(session, path, mart, *rest):
        if mart is kept.HOURS:
            raise RuntimeError("lost")
        return advance(session, path, mart, *rest)

    monkeypatch.setattr(kept, "advance", dies)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.build_marts(spark, lake)
    monkeypatch.undo()
    # readers see nothing of the attempt, and the next one adds the changes once
    assert rows_of(jobs.read_marts(spark, lake)["fct_agency_efficiency"]) == before
    jobs.build_marts(spark, lake)
    check(spark, lake)


def test_a_rebuilt_table_rebuilds_the_marts(spark, lake):
    rng = random.Random(4)
    merge(spark, lake, some(rng, 1, 20))
    jobs.build_marts(spark, lake)
    merge(spark, lake, some(rng, 2, 20), full_refresh=True)
    jobs.build_marts(spark, lake)
    check(spark, lake)
    merge(spark, lake, some(rng, 3, 20))
    jobs.build_marts(spark, lake)
    jobs.build_marts(spark, lake, full=True)
    check(spark, lake)


def test_generations_that_no_longer_count_are_deleted(spark, lake):
    for day in range(1, 6):
        merge(spark, lake, [request(1, day, agency=str(day))])
        jobs.build_marts(spark, lake)
    folders = glob.glob(f"{lake.marts}/kept/{kept.AGENCY.name}/*/part=2025-01")
    assert len(folders) == 2  # the one that counts, and the one before for those who still read it
    assert not glob.glob(f"{lake.changes}/change=*")
    check(spark, lake)


def test_signed_images(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old")], "k string, v int, w string")
    batch = spark.createDataFrame([("a", 2, "new"), ("b", 4, "new"), ("c", 1, "new")], target.schema)
    plain = {tuple(r) for r in signed_images(target, batch, "k", "v").collect()}
    assert plain == {
        ("a", 1, "old", -1), ("a", 2, "new", 1), ("b", 5, "old", -1), ("b", 4, "new", 1),
        ("c", 1, "new", 1),
    }
    newer = signed_images(target, batch, "k", "v", newer_only=True)
    totals = newer.groupBy("k", "v", "w").agg(F.sum(SIGN).alias("n")).filter("n <> 0")
    assert {tuple(r) for r in totals.collect()} == {
        ("a", 1, "old", -1), ("a", 2, "new", 1), ("c", 1, "new", 1),
    }


def test_marts_need_to_be_built_first(spark, lake):
    merge(spark, lake, [request(1, 1)])
    with pytest.raises(ValueError, match="not been built"):
        jobs.read_marts(spark, lake)


# The key table -------------------------------------------------------------------------


def month_files(lake, month):
    return glob.glob(f"{lake.staged_complaints}/created_part={month}-01/*.parquet")


def test_a_merge_reads_only_partitions_that_hold_its_keys(spark, lake):
    merge(spark, lake, [
        request(n, 1, created_date=f"2025-0{1 + n % 4}-05T00:00:00") for n in range(20)
    ])
    # the slice of a run starts with the day of the one before
    merge(spark, lake, [request(4, 2)])
    # a file that cannot be read stands for all that must not be
    for path in month_files(lake, "2025-03"):
        with open(path, "wb") as file:
            file.write(b"nothing to read here")
    # request 0 moves from January to February
    merge(spark, lake, [request(0, 3, created_date="2025-02-07T00:00:00"), request(50, 3)])
    rows = spark.read.parquet(lake.staged_complaints).filter("created_part <> '2025-03-01'")
    found = {r.unique_key: r.created_date.month for r in rows.collect()}
    assert found["0"] == 2 and found["50"] == 1 and len(found) == 16


def test_the_key_table_is_not_shuffled(spark, folder):
    from civicspark.sinks.keys import KeyTable

    rows = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS k", "DATE '2025-01-01' + CAST(id % 3 AS INT) AS p"
    )
    keys = KeyTable(spark, f"{folder}/keys", "k", "p")
    keys.rebuild(rows, 1)
    keys.append(rows.filter("k < '2'").withColumn("p", F.lit("2026-01-01").cast("date")), 2)
    assert {r.p.year for r in keys.places(rows.filter("k = '1'")).collect()} == {2026}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = keys.places(rows)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        # the batch is dealt to the buckets, and nothing else
        assert final.count("Exchange hashpartitioning") == 1
        assert "Bucketed: true" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_key_table_is_written_anew_after_many_merges(spark, lake, monkeypatch):
    from civicspark.sinks import keys

    monkeypatch.setattr(keys, "MOST_MERGES", 2)
    for day in range(1, 7):
        merge(spark, lake, [request(1, day, created_date=f"2025-0{day}-05T00:00:00")])
    assert [(r.unique_key, r.created_date.month) for r in
            jobs.staged_complaints(spark, lake).collect()] == [("1", 6)]
    table = keys.KeyTable(spark, lake.keys, "unique_key", "created_part").table()
    assert table.count() < 6
    assert len(glob.glob(f"{lake.keys}/table=*")) == 1


def test_a_table_without_keys_gets_them(spark, lake):
    import shutil

    merge(spark, lake, [request(1, 1)])
    shutil.rmtree(lake.keys)
    merge(spark, lake, [request(1, 2, created_date="2025-02-05T00:00:00")])
    assert jobs.staged_complaints(spark, lake).count() == 1


def test_changes_are_shuffled_once_together_with_what_is_held(spark, lake, monkeypatch):
    merge(spark, lake, [request(n, 1) for n in range(5)])
    jobs.build_marts(spark, lake)
    written, write = [], kept._write

    def watched(frame, *where):
        written.append(frame._jdf.queryExecution().executedPlan().toString())
        write(frame, *where)

    monkeypatch.setattr(kept, "_write", watched)
    merge(spark, lake, [request(2, 2, borough="Z")])
    jobs.build_marts(spark, lake)
    assert [plan.count("ENSURE_REQUIREMENTS") for plan in written] == [1] * len(kept.ALL)
    check(spark, lake)


def test_a_value_that_moves_to_another_null_column_changes_its_month(spark, lake):
    merge(spark, lake, [request(1, 1, borough="X", city=None), request(2, 1)])
    jobs.build_marts(spark, lake)
    merge(spark, lake, [request(1, 2, borough=None, city="X")])
    jobs.build_marts(spark, lake)
    places = {(r.borough, r.city) for r in check(spark, lake)["fct_agency_efficiency"].collect()}
    assert places == {(None, "X"), ("B", "C")}


def test_keys_lie_in_the_staged_tables_buckets(spark, lake):
    from civicspark.sinks.buckets import bucket_count
    from civicspark.sinks.keys import KeyTable

    for day, options in ((1, {}), (2, {}), (3, {"full_refresh": True})):
        merge(spark, lake, [request(n, day) for n in range(20)], **options)
        table = KeyTable(spark, lake.keys, "unique_key", "created_part")
        assert table._current()[1] == bucket_count(spark, lake.staged_complaints)
        assert table.table().select("unique_key").distinct().count() == 20
