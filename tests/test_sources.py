from __future__ import annotations

import json
import os
import random

import pytest
from helpers import at
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.sinks.tables import overwrite_table, write_ndjson
from civicspark.sources import extract, files, state
from civicspark.sources.header_rows import header_rows_to_table
from civicspark.sources.keyset import slice_after, walk_slices

LINES = [
    json.dumps(
        {
            "unique_key": "1",
            "status": "Closed",
            "created_date": "2025-01-01T10:00:00.000",
            "closed_date": "2025-01-02T10:00:00.000",
            ":updated_at": "2025-01-03T00:00:00.123Z",
            ":id": "dropped",
            ":version": "dropped",
        }
    ),
    json.dumps({"unique_key": "2", "created_date": "not a time"}),
    json.dumps({"status": "Open"}),
    "{broken",
]


@pytest.fixture
def bronze(folder):
    path = f"{folder}/bronze"
    os.makedirs(path)
    with open(f"{path}/a.ndjson", "w") as out:
        out.write("\n".join(LINES) + "\n")
    return path


def test_raw_scan_applies_the_declared_schema(spark, bronze):
    df = files.read_complaints(spark, bronze)
    assert df.columns == schemas.RAW_COMPLAINT.names and len(df.columns) == 24
    rows = {r.unique_key or r.status: r for r in df.collect()}
    assert len(df.collect()) == 4
    assert rows["1"].created_date == at("2025-01-01T10:00:00")
    assert rows["1"][":updated_at"] == at("2025-01-03T00:00:00.123")
    assert rows["2"].created_date is None
    assert rows["Open"].unique_key is None
    assert all(value is None for value in rows[None])


def test_bad_lines_are_counted(spark, bronze):
    row = files.quarantine_counts(spark, bronze).first()
    assert (row.lines, row.bad_lines, row.keyless_lines) == (4, 2, 2)
    assert len(schemas.RAW_COMPLAINT.fields) == 24


def test_file_mark_and_newer_files(spark, bronze, folder):
    silver = f"{folder}/silver"
    assert files.silver_mark(spark, silver) == schemas.MARK_MISSING
    os.makedirs(silver)
    assert files.silver_mark(spark, silver) == schemas.MARK_EMPTY
    overwrite_table(spark.range(3), silver)
    old, new = 1_700_000_000, 1_700_000_100
    for name in os.listdir(silver):
        os.utime(f"{silver}/{name}", (old, old))
    mark = files.silver_mark(spark, silver)
    os.utime(f"{bronze}/a.ndjson", (old, old))
    assert files.read_complaints(spark, bronze, mark).count() == 0
    os.utime(f"{bronze}/a.ndjson", (new, new))
    assert files.read_complaints(spark, bronze, mark).count() == 4


def test_other_failures_do_not_look_like_a_first_run(spark, folder):
    with open(f"{folder}/x.parquet", "w") as out:
        out.write("not parquet")
    with pytest.raises(Exception):
        files.read_if_present(spark, folder).count()
    with pytest.raises(Exception):
        files.silver_mark(spark, "nosuchscheme://bucket/silver")


def test_external_tables(spark, folder):
    spark.sql("DROP TABLE IF EXISTS ext_income")
    overwrite_table(spark.range(5), f"{folder}/income")
    assert files.register_external(spark, "ext_income", f"{folder}/income").count() == 5
    overwrite_table(spark.range(7), f"{folder}/income")
    assert files.refresh_external(spark, "ext_income").count() == 7
    spark.sql("DROP TABLE ext_income")


def test_cursor_state_survives_and_only_grows(spark, folder):
    path = f"{folder}/state"
    assert state.read_state(spark, path) == schemas.FIRST_CURSOR
    state.write_state(spark, path, "2025-02-01T00:00:00.000000Z")
    state.write_state(spark, path, "2025-03-01T00:00:00.000000Z")
    assert state.read_state(spark, path) == "2025-03-01T00:00:00.000000Z"
    state.write_state(spark, path, "2025-01-15T00:00:00.000000Z", reset=True)
    assert state.read_state(spark, path) == "2025-01-15T00:00:00.000000Z"


def source(spark, rows):
    return spark.createDataFrame(rows, "k string, u string, c string").select(
        F.col("k").alias("unique_key"),
        F.col("u").cast("timestamp").alias(":updated_at"),
        F.col("c").cast("timestamp").alias("created_date"),
    )


def test_extract_is_strict_and_keeps_the_floor(spark, folder):
    df = source(
        spark,
        [
            ("at cursor", "2025-01-05T00:00:00Z", "2025-01-02"),
            ("new", "2025-01-05T00:00:00.000001Z", "2025-01-02"),
            ("newest", "2025-01-06T00:00:00Z", "2025-01-01"),
            ("too old", "2025-01-07T00:00:00Z", "2024-12-31"),
        ],
    )
    rows, seen = extract.incremental_extract(df, "2025-01-05T00:00:00.000Z")
    rows.write.json(f"{folder}/out")
    assert {r.unique_key for r in rows.collect()} == {"new", "newest"}
    assert seen.get == {"next_cursor": "2025-01-06T00:00:00.000000Z", "fetched": 2}
    after = extract.after_cursor(df, seen.get["next_cursor"])
    assert after.count() == 0
    row = extract.next_cursor(after, "2025-01-06T00:00:00Z").first()
    assert (row.next_cursor, row.fetched) == (at("2025-01-06T00:00:00"), 0)


@pytest.mark.parametrize("shape", ["spread", "one instant", "one key", "nulls"])
def test_slices_cover_every_row_once_and_in_order(spark, shape):
    dice = random.Random(7)
    rows = []
    for n in range(600):
        updated = f"2025-01-{dice.randint(1, 9):02}T0{dice.randint(0, 9)}:00:0{dice.randint(0, 9)}Z"
        key = f"{dice.randint(0, 60)}"
        if shape == "one instant" and n % 3:
            updated = "2025-01-05T05:05:05.123456Z"
        if shape == "one key" and n % 3:
            updated, key = "2025-01-05T05:05:05Z", "hot-key-value"
        if shape == "nulls" and n % 3 == 0:
            key = None
        rows.append((key, updated, f"{n:04}"))
    df = spark.createDataFrame(rows, "k string, u string, n string").select(
        F.col("u").cast("timestamp").alias("u"), "k", "n"
    ).repartition(5).cache()
    order = ["u", "k", "n"]
    wanted = [tuple(r) for r in df.orderBy(*order).collect()]
    pages = [[tuple(r) for r in page.collect()] for page in walk_slices(df, order, 90)]
    assert [len(page) for page in pages] == [90] * 6 + [60]
    assert [row for page in pages for row in page] == wanted


def test_slices_need_sortable_columns(spark):
    df = spark.range(10).select(F.current_timestamp().alias("u"), "id")
    with pytest.raises(TypeError):
        slice_after(df, ["u", "id"], None, 2)


def test_pages_with_other_columns(spark, folder):
    pages = [
        spark.createDataFrame([("1", "x")], "unique_key string, descriptor string"),
        spark.createDataFrame([("2", "y")], "unique_key string, city string"),
    ]
    for _ in range(2):
        write_ndjson(pages, folder, "20250101T000000Z")
    rows = files.read_complaints(spark, folder).select("unique_key", "descriptor", "city")
    assert {tuple(r) for r in rows.collect()} == {("1", "x", None), ("2", None, "y")}


def test_fast_gzip_holds_the_same_lines(spark, folder):
    rng = random.Random(7)
    rows = [(str(i), at("2024-01-02 03:04:05"), rng.choice(["Noise", "Rodent"])) for i in range(5_000)]
    page = spark.createDataFrame(rows, "unique_key string, created_date timestamp, descriptor string")
    sizes, lines = [], []
    for n, fast in enumerate((False, True)):
        target = write_ndjson([page.coalesce(1)], f"{folder}/{n}", "run", "gzip", fast=fast)
        (name,) = [name for name in os.listdir(target) if name.endswith(".json.gz")]
        sizes.append(os.path.getsize(f"{target}/{name}"))
        lines.append([row.value for row in spark.read.text(target).collect()])
    # another level: more space for less time
    assert sizes[0] < sizes[1] < 2 * sizes[0]
    assert lines[0] == lines[1] and len(lines[0]) == len(rows)


CELLS = [["NAME", "S1901_C01_012E", "zip code tabulation area"], ["A], B", "5", "00601"], ["C", None, "2"]]


@pytest.mark.parametrize("text", [
    json.dumps(CELLS),
    json.dumps(CELLS, separators=(",", ":")),
    "[" + ",\n".join(json.dumps(row) for row in CELLS) + "]\n",
    "[" + ",\n".join(json.dumps(row) for row in CELLS) + "]\n\n",
])
def test_header_rows_on_one_line_or_many(spark, folder, text):
    with open(f"{folder}/doc.json", "w") as out:
        out.write(text)
    df = header_rows_to_table(spark, folder)
    assert df.columns == CELLS[0]
    assert sorted(tuple(r) for r in df.collect()) == sorted(tuple(r) for r in CELLS[1:])


def test_header_rows_with_different_headers_are_refused(spark, folder):
    for n, header in enumerate((["a", "b"], ["b", "a"])):
        with open(f"{folder}/{n}.json", "w") as out:
            out.write(json.dumps([header, ["1", "2"]]))
    with pytest.raises(Exception, match="same header"):
        header_rows_to_table(spark, folder).collect()
