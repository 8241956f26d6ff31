from __future__ import annotations

import json
import os

import pytest
from helpers import at
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.operators.history import read_history
from civicspark.operators.quality import QualityError
from civicspark.plans import jobs
from civicspark.session import INITIAL_PARTITIONS
from civicspark.sinks.tables import overwrite_table
from civicspark.streaming.loads import LOAD, stream_silver, stream_upsert

DAY_ONE = [
    ("1", "Open", "2025-03-01T08:00:00", "2025-03-01T09:00:00"),
    ("2", "Open", "2025-03-01T08:00:00", "2025-03-01T09:30:00"),
]
DAY_TWO = [
    ("1", "Closed", "2025-03-01T08:00:00", "2025-03-02T09:00:00"),
    ("3", "Open", "2025-03-02T08:00:00", "2025-03-02T10:00:00"),
]


def source(spark, rows):
    known = spark.createDataFrame(rows, "k string, s string, c string, u string")
    values = {
        "unique_key": F.col("k"),
        "status": F.col("s"),
        "created_date": F.col("c"),
        "closed_date": F.when(F.col("s") == "Closed", F.col("u")),
        ":updated_at": F.col("u"),
        "incident_zip": F.lit("10001"),
        "borough": F.lit("B"),
    }
    return known.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.RAW_COMPLAINT
        ]
    )


@pytest.fixture
def lake(spark, folder):
    where = jobs.Lake(folder)
    raw = spark.createDataFrame(
        [("ZCTA 10001", "50000", "10001"), ("ZCTA 2", "-666666666", "2")],
        "NAME string, S1901_C01_012E string, `zip code tabulation area` string",
    )
    overwrite_table(raw, where.bronze_income)
    return where


def staged(spark, lake):
    rows = jobs.staged_complaints(spark, lake).collect()
    return sorted((r.unique_key, r.status, r.resolution_time_days) for r in rows)


def backdate(folder, seconds):
    """Make files look older, as if the runs were further apart than this test's steps."""
    for root, _, names in os.walk(folder):
        for name in names:
            path = os.path.join(root, name)
            os.utime(path, (os.stat(path).st_mtime - seconds,) * 2)


def run(spark, lake, number, rows, **options):
    fetched = jobs.extract_complaints(spark, lake, source(spark, rows), f"run{number}")
    moment = at(f"2025-03-0{number}T12:00:00")
    tables = jobs.run_daily(spark, lake, f"run{number}", moment, **options)
    backdate(lake.bronze_complaints, 100)
    backdate(lake.silver_complaints, 50)
    return fetched, tables


def test_two_days_incrementally_then_rebuilt(spark, lake):
    fetched, _ = run(spark, lake, 1, DAY_ONE)
    assert fetched == 2
    fetched, tables = run(spark, lake, 2, DAY_ONE + DAY_TWO)
    assert fetched == 2
    wanted = [("1", "closed", 1), ("2", "open", None), ("3", "open", None)]
    assert staged(spark, lake) == wanted
    history = read_history(spark, lake.history)
    assert sorted((r.unique_key, r.status, r.dbt_valid_to is None) for r in history.collect()) == [
        ("1", "closed", True),
        ("1", "open", False),
        ("2", "open", True),
        ("3", "open", True),
    ]
    cases = tables["fct_agency_efficiency"].agg(F.sum("total_cases"), F.sum("total_cases_closed"))
    assert tuple(cases.first()) == (3, 1)
    assert spark.table("fct_income_resolution").first().median_income == 50000

    # Nothing new: no cursor move, no new rows, no new versions.
    cursor = jobs.read_state(spark, lake.state)
    fetched, _ = run(spark, lake, 3, DAY_ONE + DAY_TWO)
    assert fetched == 0 and jobs.read_state(spark, lake.state) == cursor
    assert staged(spark, lake) == wanted
    assert read_history(spark, lake.history).count() == 4
    assert spark.read.parquet(lake.silver_complaints).count() == 4

    run(spark, lake, 4, DAY_ONE + DAY_TWO, full_refresh=True)
    assert staged(spark, lake) == wanted


def test_failing_checks_stop_the_chain(spark, lake):
    with pytest.raises(QualityError, match="accepted_values"):
        run(spark, lake, 1, [("1", "Reopened", "2025-03-01T08:00:00", "2025-03-01T09:00:00")])
    assert not os.path.exists(lake.history)


def test_optional_checks(spark, lake):
    run(spark, lake, 1, DAY_ONE, strict=True)
    overwrite_table(spark.createDataFrame([("2", 5)], schemas.STAGED_INCOME), lake.staged_income)
    assert jobs.check_staging(spark, lake)["negative_income"] == 0
    with pytest.raises(QualityError, match="relationships"):
        jobs.check_staging(spark, lake, strict=True)


def test_rows_without_a_key_do_not_reach_the_staged_table(spark, lake):
    rows = DAY_ONE + [(None, "Open", "2025-03-01T08:00:00", "2025-03-01T09:45:00")]
    with pytest.raises(QualityError, match="'keyless': 1"):
        run(spark, lake, 1, rows)
    assert [k for k, _, _ in staged(spark, lake)] == ["1", "2"]
    assert spark.read.parquet(lake.silver_complaints).filter("unique_key IS NULL").count() == 1
    assert spark.read.parquet(f"{lake.keyless}/run=run1").count() == 1
    assert not os.path.exists(lake.history)


def test_malformed_lines_are_kept_apart_and_counted(spark, lake, folder):
    os.makedirs(f"{folder}/api")
    good = record("1", "Open", "2025-03-01") | {":version": "rv-7"}
    late = record("2", "Open", "2025-03-01") | {":updated_at": "2025-03-01T00:00:00.000900Z"}
    with open(f"{folder}/api/page.ndjson", "w") as out:
        out.write(json.dumps(good) + "\n{bad\n" + json.dumps(late) + "\n\n")
        out.write(json.dumps(record("3", "Open", "2025-03-01") | {"created_date": "soon"}) + "\n")
    assert jobs.extract_lines(spark, lake, f"{folder}/api", "one") == {"fetched": 2, "rejected": 2}
    assert spark.read.text(f"{lake.rejected}/run=one").count() == 2
    stored = [json.loads(r.value) for r in spark.read.text(f"{lake.bronze_complaints}/*").collect()]
    assert sorted(r["unique_key"] for r in stored) == ["1", "2"] and good in stored
    assert jobs.read_state(spark, lake.state) == "2025-03-01T00:00:00.000900Z"
    assert jobs.extract_lines(spark, lake, f"{folder}/api", "two") == {"fetched": 0, "rejected": 2}
    # the same lines are not stored twice, those of another file are
    lines(f"{folder}/api", "more", record("4", "Open", "2025-03-04"))
    with open(f"{folder}/api/more.ndjson", "a") as out:
        out.write("{bad\n")
    assert jobs.extract_lines(spark, lake, f"{folder}/api", "three") == {"fetched": 1, "rejected": 3}
    rejected = spark.read.json(lake.rejected)
    assert rejected.filter("run = 'two'").count() == 0 and rejected.count() == 3
    assert rejected.filter("value = '{bad'").select("file").distinct().count() == 2
    # a run that is repeated under its name stores what it stored before
    jobs.extract_lines(spark, lake, f"{folder}/api", "three")
    assert spark.read.json(lake.rejected).count() == 3


def test_a_late_old_file_is_loaded(spark, lake):
    run(spark, lake, 1, DAY_ONE)
    lines(lake.bronze_complaints, "late", record("9", "Open", "2025-02-01"), modified=1_000_000_000)
    jobs.run_daily(spark, lake, "run2", at("2025-03-02T12:00:00"))
    assert [k for k, _, _ in staged(spark, lake)] == ["1", "2", "9"]


def test_marts_outlive_the_run_and_follow_the_next(spark, lake):
    run(spark, lake, 1, DAY_ONE)
    stored = jobs.read_marts(spark.newSession(), lake)
    assert set(stored) == set(jobs.MARTS) and all(table.schema for table in stored.values())
    _, tables = run(spark, lake, 2, DAY_TWO)
    stored = jobs.read_marts(spark.newSession(), lake)["fct_agency_efficiency"]
    assert stored.agg(F.sum("total_cases")).first()[0] == 3
    assert tables["fct_agency_efficiency"].agg(F.sum("total_cases")).first()[0] == 3


def test_steps_leave_the_callers_settings_alone(spark, lake):
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    run(spark, lake, 1, DAY_ONE)
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def lines(folder, name, *records, modified=None):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.ndjson"
    with open(path, "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)
    if modified:
        os.utime(path, (modified, modified))


def record(key, status, updated):
    return {"unique_key": key, "status": status, "created_date": "2025-03-01T08:00:00.000",
            "closed_date": "2025-03-05T08:00:00.000" if status == "Closed" else None,
            ":updated_at": f"{updated}T00:00:00.000Z"}


def load(spark, lake, **options):
    stream_silver(
        spark, lake.bronze_complaints, lake.silver_complaints, lake.silver_checkpoint, **options
    ).awaitTermination()
    return spark.read.parquet(lake.silver_complaints)


def test_stream_takes_each_file_once_even_a_late_old_one(spark, lake):
    one, two = record("1", "Open", "2025-03-01"), record("2", "Closed", "2025-03-02")
    lines(lake.bronze_complaints, "a", one, one, two)
    assert load(spark, lake).count() == 2
    assert load(spark, lake).count() == 2
    lines(lake.bronze_complaints, "late", record("3", "Open", "2025-03-03"), modified=1_000_000_000)
    silver = load(spark, lake)
    assert silver.count() == 3
    assert {r.resolution_time_days for r in silver.collect()} == {None, 4}


def test_a_repeated_micro_batch_replaces_its_first_attempt(spark, lake):
    lines(lake.bronze_complaints, "a", record("1", "Open", "2025-03-01"))
    before = load(spark, lake)
    assert before.count() == 1
    loads = {r[0] for r in before.select(LOAD).distinct().collect()}
    # Forget that the batch was committed, as if the driver died just before noting it.
    os.remove(f"{lake.silver_checkpoint}/commits/0")
    for name in os.listdir(f"{lake.silver_checkpoint}/commits"):
        if name.startswith(".0"):
            os.remove(f"{lake.silver_checkpoint}/commits/{name}")
    after = load(spark, lake)
    assert after.count() == 1
    assert {r[0] for r in after.select(LOAD).distinct().collect()} == loads


def test_stream_upsert_equals_the_batch_merge(spark, lake):
    def upsert():
        stream_upsert(
            spark, lake.silver_complaints, lake.staged_complaints, lake.staged_checkpoint,
            files_per_batch=1,
        ).awaitTermination()

    lines(lake.bronze_complaints, "a", record("1", "Open", "2025-03-01"),
          record("2", "Open", "2025-03-01"), {"status": "Open"})
    load(spark, lake)
    upsert()
    lines(lake.bronze_complaints, "b", record("1", "Closed", "2025-03-04"),
          record("3", "Open", "2025-03-04"))
    load(spark, lake, files_per_batch=1)
    upsert()
    wanted = [("1", "closed", 4), ("2", "open", None), ("3", "open", None)]
    assert staged(spark, lake) == wanted
    upsert()
    assert staged(spark, lake) == wanted


def test_a_streamed_table_has_the_buckets_its_files_need(spark, lake):
    from civicspark.sinks.buckets import bucket_count

    lines(lake.bronze_complaints, "a", *[record(str(n), "Open", "2025-03-01") for n in range(40)])
    load(spark, lake)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        stream_upsert(
            spark, lake.silver_complaints, lake.staged_complaints, lake.staged_checkpoint
        ).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # not one, and one file, for every partition of a shuffle
    assert bucket_count(spark, lake.staged_complaints) == 1
    (part,) = [name for name in os.listdir(lake.staged_complaints) if name.startswith("created")]
    files = os.listdir(f"{lake.staged_complaints}/{part}")
    assert len([name for name in files if name.endswith(".parquet")]) == 1
    assert len(staged(spark, lake)) == 40


def test_a_stream_removes_copies_before_it_derives(spark, lake, monkeypatch):
    from civicspark.streaming import loads

    seen, dedup = [], loads.dedup_exact
    monkeypatch.setattr(loads, "dedup_exact", lambda df: seen.append(df.columns) or dedup(df))
    one = record("1", "Closed", "2025-03-04")
    lines(lake.bronze_complaints, "a", one, one)
    at_instant = at("2025-03-09T10:00:00")
    (row,) = load(spark, lake, at=at_instant).collect()
    assert (row.resolution_time_days, row.ingest_date.isoformat()) == (4, "2025-03-09")
    assert seen and not {"SLA_days", "resolution_time_days", "ingest_date"} & set(seen[0])


def test_command_line_steps(spark, lake, folder, capsys):
    from civicspark.__main__ import main

    lines(f"{folder}/api", "page", record("1", "Open", "2025-03-01"), record("2", "Closed", "2025-03-02"))
    os.makedirs(f"{folder}/census")
    with open(f"{folder}/census/doc.json", "w") as out:
        out.write('[["NAME","S1901_C01_012E","zip code tabulation area"],\n["Z","5","00001"]]')

    def step(task, *more):
        main(["--task", task, "--root", folder, *more])

    step("extract", "--source", f"{folder}/api")
    assert "extracted 2 rows, rejected 0 lines" in capsys.readouterr().out
    step("extract_income", "--source", f"{folder}/census")
    for task in ("complaints", "median_income", "staging", "test", "snapshot", "mart"):
        step(task)
    assert "rows left out for want of a key: 0" in capsys.readouterr().out
    assert spark.table("stg_complaints").count() == 2
    assert spark.table("stg_median_income").first().median_income == 5
    assert spark.table("complaints_snapshots").count() == 2
    with pytest.raises(SystemExit):
        main(["--task", "extract", "--root", folder])


def test_the_test_step_sees_what_the_staging_step_left_out(spark, lake, folder):
    from civicspark.__main__ import main

    lines(f"{folder}/api", "page", record("1", "Open", "2025-03-01"), record(None, "Open", "2025-03-02"))
    jobs.load_income(spark, lake)
    main(["--task", "extract", "--root", folder, "--source", f"{folder}/api"])
    for task in ("complaints", "staging"):
        main(["--task", task, "--root", folder])
    with pytest.raises(QualityError, match="'keyless': 1"):
        main(["--task", "test", "--root", folder])


def test_a_run_without_any_rows(spark, lake):
    empty = source(spark, DAY_ONE).limit(0)
    assert jobs.extract_complaints(spark, lake, empty, "run1") == 0
    jobs.run_daily(spark, lake, "run1", at("2025-03-01T12:00:00"))
    assert staged(spark, lake) == []
    run(spark, lake, 2, DAY_ONE)
    assert [k for k, _, _ in staged(spark, lake)] == ["1", "2"]
