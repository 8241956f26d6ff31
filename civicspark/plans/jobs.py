"""The daily chain: extract, Silver, staging, checks, history, marts.

Every step works in a session of its own, with shuffles sized by what it reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from civicspark import schemas
from civicspark.operators import quality
from civicspark.operators.dedup import latest_per_key
from civicspark.operators.history import read_history, take_snapshot
from civicspark.operators.upsert import SIGN, merge_into, merge_stored
from civicspark.plans import dashboard, kept
from civicspark.plans.silver import silver_complaints, silver_income
from civicspark.plans.staging import (
    KEY,
    UPDATED,
    keyless,
    since_last_ingest,
    stage_complaints,
    stage_income,
)
from civicspark.session import own_session, prepare, remove_folders, size_shuffles
from civicspark.sinks.buckets import (
    bucket_count,
    buckets_for,
    dealt_into,
    read_buckets,
    write_buckets,
)
from civicspark.sinks.keys import KeyTable
from civicspark.sinks.tables import (
    CLUSTER_COLUMNS,
    LAYOUT_COLUMN,
    append_silver,
    overwrite_table,
    register_mart,
    with_layout_column,
    write_ndjson,
)
from civicspark.sources.extract import incremental_extract
from civicspark.sources.files import (
    path_exists,
    read_complaints,
    read_income,
    read_lines,
    read_silver,
    rejected_line,
    silver_mark,
)
from civicspark.sources.header_rows import header_rows_to_table
from civicspark.sources.state import read_state, write_state
from civicspark.streaming.loads import stream_silver


class Lake:
    """Where each layer is stored under one root folder."""

    def __init__(self, root: str):
        self.root = root
        self.state = f"{root}/metadata/state"
        self.silver_checkpoint = f"{root}/metadata/checkpoints/silver"
        self.staged_checkpoint = f"{root}/metadata/checkpoints/staged"
        self.bronze_complaints = f"{root}/bronze/complaints"
        self.rejected = f"{root}/bronze/rejected"
        self.keyless = f"{root}/staging/keyless"
        self.staged_mark = f"{root}/metadata/marks/staged"
        self.history_mark = f"{root}/metadata/marks/history"
        self.changes = f"{root}/staging/changes"
        self.keys = f"{root}/staging/keys"
        self.keyless_mark = f"{root}/metadata/marks/keyless"
        self.changes_mark = f"{root}/metadata/marks/changes"
        self.rebuilt_mark = f"{root}/metadata/marks/rebuilt"
        self.kept_mark = f"{root}/metadata/marks/kept"
        self.marts = f"{root}/marts"
        self.bronze_income = f"{root}/bronze/median_income"
        self.silver_complaints = f"{root}/silver/complaints"
        self.silver_income = f"{root}/silver/median_income"
        self.staged_complaints = f"{root}/staging/stg_complaints"
        self.staged_income = f"{root}/staging/stg_median_income"
        self.history = f"{root}/snapshots/complaints_snapshots"


def extract_complaints(
    spark: SparkSession,
    lake: Lake,
    source: DataFrame,
    run: str,
    first_cursor: str = schemas.FIRST_CURSOR,
    floor: str = schemas.CREATED_FLOOR,
    compression: str = "none",
) -> int:
    """Store the source rows past the cursor as JSON lines, then move the cursor.  Returns the
    number of rows; with none, the cursor stays."""
    cursor = read_state(spark, lake.state, first_cursor)
    rows, seen = incremental_extract(source, cursor, floor)
    if cursor != first_cursor:
        # A day's changes are few rows from many tasks: gather them into files of a fair size.
        rows = rows.hint("rebalance")
    write_ndjson([rows], lake.bronze_complaints, run, compression)
    fetched = seen.get["fetched"]
    if fetched:
        write_state(spark, lake.state, seen.get["next_cursor"])
    return fetched


def extract_lines(
    spark: SparkSession,
    lake: Lake,
    source: str,
    run: str,
    first_cursor: str = schemas.FIRST_CURSOR,
    floor: str = schemas.CREATED_FLOOR,
    compression: str = "none",
) -> dict[str, int]:
    """Store the raw JSON lines of ``source`` that are past the cursor, with all their fields, then
    move the cursor.  Lines that do not parse, or that lack one of the two times the cursor needs,
    are stored apart with the file they are from, those that an earlier run has stored not again.
    Returns the numbers of rows stored and of lines that were rejected, known ones included."""
    cursor = read_state(spark, lake.state, first_cursor)
    lines = read_lines(spark, source, "file")
    placed = lines.filter(~rejected_line()).select(
        F.col("`record`.`:updated_at`").alias(":updated_at"),
        F.col("record.created_date").alias("created_date"),
        "value",
    )
    rows, seen = incremental_extract(placed, cursor, floor)
    rows.select("value").write.mode("overwrite").text(
        f"{lake.bronze_complaints}/data_{run}.ndjson", compression=compression
    )
    bad, counted = lines.filter(rejected_line()).select("file", "value"), Observation()
    bad = bad.observe(counted, F.count(F.lit(1)).alias("rejected"))
    if path_exists(spark, lake.rejected):
        known = spark.read.schema("file string, value string, run string").json(lake.rejected)
        known = known.filter(F.col("run") != run).select("file", "value")
        bad = bad.join(known, ["file", "value"], "left_anti")
    bad.write.mode("overwrite").json(f"{lake.rejected}/run={run}", compression=compression)
    fetched = seen.get["fetched"]
    if fetched:
        write_state(spark, lake.state, seen.get["next_cursor"])
    return {"fetched": fetched, "rejected": counted.get["rejected"]}


def extract_income(spark: SparkSession, lake: Lake, documents: str) -> None:
    """Replace the raw incomes by the rows of header-row JSON documents."""
    overwrite_table(header_rows_to_table(spark, documents), lake.bronze_income)


def load_silver(spark: SparkSession, lake: Lake, at: datetime | None = None) -> None:
    """Append the raw files newer than the last Silver file.  A raw file that lands while this
    runs, or whose time is older, is missed; the daily run uses ``stream_silver``, which has no
    such window."""
    raw = read_complaints(
        spark, lake.bronze_complaints, silver_mark(spark, lake.silver_complaints)
    )
    append_silver(silver_complaints(raw, at), lake.silver_complaints)


def load_income(spark: SparkSession, lake: Lake) -> None:
    raw = read_income(spark, lake.bronze_income)
    overwrite_table(silver_income(raw), lake.silver_income)


def build_staging(
    spark: SparkSession,
    lake: Lake,
    full_refresh: bool = False,
    granularity: str = "day",
    run: str | None = None,
) -> DataFrame:
    """Bring the staged tables up to date and return the Silver rows left out for want of a key,
    which are stored under the run's name for the checks.  An incremental run merges what was ingested since the last one; a full refresh, or a
    first run, rebuilds the table.

    How far a run has come is stored beside the table, after it, so a run that died is repeated.
    A merge first stores what it will change (``Lake.changes``), for the marts to follow, and a
    merge that died after that is finished before anything else, from what it stored."""
    spark = own_session(spark)
    finish_merge(spark, lake)
    number = _number(spark, lake.changes_mark) + 1
    rebuilt = full_refresh or not path_exists(spark, lake.staged_complaints)
    if rebuilt:
        # Whatever becomes of this run, sums kept over the table as it was do not hold any more.
        _write_number(spark, lake.rebuilt_mark, number)
    silver = read_silver(spark, lake.silver_complaints)
    fresh = since_last_ingest(silver, None if full_refresh else _mark(spark, lake.staged_mark))
    size_shuffles(spark, fresh)
    keyed = stage_complaints(fresh).filter(F.col(KEY).isNotNull())
    if full_refresh:
        latest = with_layout_column(latest_per_key(keyed, KEY, UPDATED), granularity=granularity)
        buckets = buckets_for(keyed)
        with dealt_into(latest, buckets):
            write_buckets(latest, lake.staged_complaints, KEY, CLUSTER_COLUMNS, buckets)
    else:
        merge_into(
            spark,
            lake.staged_complaints,
            keyed,
            KEY,
            UPDATED,
            granularity=granularity,
            changes=None if rebuilt else changes_of(lake, number),
            places=None if rebuilt else _keys(spark, lake).places,
            merged=lambda batch: _keys(spark, lake).append(batch, number),
        )
    if rebuilt:
        _keys(spark, lake, number)
    _write_number(spark, lake.changes_mark, number)
    overwrite_table(stage_income(spark.read.parquet(lake.silver_income)), lake.staged_income)
    run = run or f"merge{number}"
    keyless(fresh).write.mode("overwrite").parquet(_keyless_folder(lake, run))
    write_state(spark, lake.keyless_mark, f"{number:012d}/{run}")
    _advance(spark, lake.staged_mark, fresh)
    return left_out_of_staging(spark, lake)


def _keyless_folder(lake: Lake, run: str) -> str:
    return f"{lake.keyless}/run={run}"


def left_out_of_staging(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The rows that the last ``build_staging`` left out; None if there has been none."""
    run = read_state(spark, lake.keyless_mark, "").partition("/")[2]
    if not run:
        return None
    return spark.read.schema(schemas.SILVER_COMPLAINT).parquet(_keyless_folder(lake, run))


def _keys(spark: SparkSession, lake: Lake, rebuilt: int | None = None) -> KeyTable:
    """The staged table's keys.  They are taken from the whole table when it was ``rebuilt`` (by the
    run of that number), or when there are none yet."""
    keys = KeyTable(spark, lake.keys, KEY, LAYOUT_COLUMN)
    if rebuilt is not None or not keys.exists():
        number = _number(spark, lake.changes_mark) if rebuilt is None else rebuilt
        layout = StructType([*schemas.STAGED_COMPLAINT.fields, StructField(LAYOUT_COLUMN, DateType())])
        path, buckets = lake.staged_complaints, bucket_count(spark, lake.staged_complaints)
        stored = read_buckets(spark, path, layout, KEY, CLUSTER_COLUMNS)
        if stored is None:
            stored = spark.read.schema(layout).parquet(path)
        keys.rebuild(stored.select(KEY, LAYOUT_COLUMN), number, buckets)
    return keys


def _with_sign() -> StructType:
    return StructType([*schemas.STAGED_COMPLAINT.fields, StructField(SIGN, IntegerType())])


def changes_of(lake: Lake, number: int) -> str:
    return f"{lake.changes}/change={number}"


def finish_merge(spark: SparkSession, lake: Lake) -> None:
    """Finish a merge that died after it had stored its changes.  The rows it was to put in place are
    among them, and putting them there again changes nothing."""
    number = _number(spark, lake.changes_mark) + 1
    folder = changes_of(lake, number)
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        return
    if number > _number(spark, lake.rebuilt_mark):
        images = spark.read.parquet(folder)
        batch = images.filter(F.col(SIGN) > 0).drop(SIGN)
        keys = _keys(spark, lake)
        merge_stored(
            spark, lake.staged_complaints, batch, KEY, UPDATED, places=keys.places
        )
        keys.append(batch, number)
    _write_number(spark, lake.changes_mark, number)


def _number(spark: SparkSession, path: str) -> int:
    return int(read_state(spark, path, "0"))


def _write_number(spark: SparkSession, path: str, number: int) -> None:
    # States are texts of which the greatest counts.
    write_state(spark, path, f"{number:012d}")


def _mark(spark: SparkSession, path: str) -> str | None:
    return read_state(spark, path, "") or None


def _advance(spark: SparkSession, path: str, fresh: DataFrame) -> None:
    """Store the newest ingest date of what was taken; it is read from the folder names alone."""
    newest = fresh.select(F.max("ingest_date").cast("string")).first()[0]
    if newest:
        write_state(spark, path, newest)


def staged_complaints(spark: SparkSession, lake: Lake) -> DataFrame:
    stored = spark.read.schema(schemas.STAGED_COMPLAINT).parquet(lake.staged_complaints)
    return stored.drop(LAYOUT_COLUMN)


def _staged_by_key(spark: SparkSession, lake: Lake) -> tuple[DataFrame, int | None]:
    """The staged table read by its buckets, and their number, if it has any."""
    layout = StructType([*schemas.STAGED_COMPLAINT.fields, StructField(LAYOUT_COLUMN, DateType())])
    stored = read_buckets(spark, lake.staged_complaints, layout, KEY, CLUSTER_COLUMNS)
    if stored is None:
        return staged_complaints(spark, lake), None
    return stored.drop(LAYOUT_COLUMN), bucket_count(spark, lake.staged_complaints)


def staging_failures(
    spark: SparkSession, lake: Lake, left_out: DataFrame | None = None, strict: bool = False
) -> list[DataFrame]:
    """Failure counts of the staging checks, as one-row frames.

    ``left_out`` are rows that never reached the staged table for want of a key; malformed lines
    are among them.  They count as failing, as they would in a table that held them.  ``strict``
    adds the checks that are off by default: the income table's key, and an income row for
    every ZIP code."""
    staged = staged_complaints(spark, lake)
    income = spark.read.schema(schemas.STAGED_INCOME).parquet(lake.staged_income)
    failing = {"negative_income": quality.check_negative_income(income)}
    if left_out is not None:
        failing["keyless"] = left_out
    if strict:
        failing["income_key"] = quality.check_income_key(income)
        failing["relationships"] = quality.check_relationship(
            staged, "incident_zip", income, "zip_code"
        )
    return [
        quality.staging_summary(staged),
        *[rows.agg(F.count("*").alias(name)) for name, rows in failing.items()],
    ]


def check_staging(
    spark: SparkSession, lake: Lake, strict: bool = False, left_out: DataFrame | None = None
) -> dict[str, int]:
    """The counts of ``staging_failures``; raises when one is not zero.  Unless ``left_out`` is given,
    the rows count that the last ``build_staging`` left out."""
    session = own_session(spark)
    if left_out is None:
        left_out = left_out_of_staging(session, lake)
    return quality.gate(*staging_failures(session, lake, left_out, strict))


def take_history(
    spark: SparkSession, lake: Lake, run: str, full: bool = False, granularity: str = "day"
) -> None:
    """Add the staged table's changes to the history.  A merge only changes rows ingested since
    the last run, so no others are compared; after a rebuild compare in ``full``."""
    spark = own_session(spark)
    staged, buckets = _staged_by_key(spark, lake)
    changed = since_last_ingest(staged, None if full else _mark(spark, lake.history_mark))
    size_shuffles(spark, changed)
    take_snapshot(
        spark, lake.history, changed, KEY, UPDATED, run, granularity=granularity, buckets=buckets
    )
    done = _mark(spark, lake.staged_mark)
    if done:
        write_state(spark, lake.history_mark, done)


def build_marts(spark: SparkSession, lake: Lake, full: bool = False) -> None:
    """Bring what is kept of the marts up to the staged table: by the changes merged since the last
    time, which reads the months they touch and nothing of the staged table, or, after a rebuild of
    that table or with ``full``, from all of it.

    A table that something else than ``build_staging`` merges into needs ``full``."""
    spark = own_session(spark)
    finish_merge(spark, lake)
    done, rebuilt = _number(spark, lake.changes_mark), _number(spark, lake.rebuilt_mark)
    base, kept_to = _kept(spark, lake)
    if full or base is None or rebuilt > kept_to:
        # A number of its own, so that no earlier generation is written over.
        generation = max(done, kept_to + 1)
        _write_number(spark, lake.changes_mark, generation)
        staged = staged_complaints(spark, lake)
        size_shuffles(spark, staged)
        for mart in kept.ALL:
            kept.rebuild(kept_path(lake, mart), mart, staged, generation)
        _write_kept(spark, lake, generation, generation)
        return
    if done == kept_to:
        return
    folders = [changes_of(lake, n) for n in range(kept_to + 1, done + 1)]
    stored = [folder for folder in folders if path_exists(spark, folder)]
    if stored:
        images = spark.read.schema(_with_sign()).parquet(*stored)
        size_shuffles(spark, images)
        changed = kept.months_changed(images)
        for mart in kept.ALL:
            path, parts = kept_path(lake, mart), changed[mart.name]
            kept.advance(spark, path, mart, images, base, kept_to, done, parts)
    _write_kept(spark, lake, base, done)
    # What counted until now stays for its readers until the next time.
    for mart in kept.ALL:
        kept.forget(spark, kept_path(lake, mart), mart, base, kept_to)
    remove_folders(spark, *stored)


def _kept(spark: SparkSession, lake: Lake) -> tuple[int | None, int]:
    """The generations of the marts that count, from and to; no first one if there are none."""
    newest, _, base = read_state(spark, lake.kept_mark, "").partition("/")
    return (int(base), int(newest)) if base else (None, 0)


def _write_kept(spark: SparkSession, lake: Lake, base: int, newest: int) -> None:
    # One state, so that both change at once.
    write_state(spark, lake.kept_mark, f"{newest:012d}/{base:012d}")


def kept_path(lake: Lake, mart: kept.Kept) -> str:
    return f"{lake.marts}/kept/{mart.name}"


def read_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The marts and the charts' tables as of the last ``build_marts``, from what is kept, with the
    incomes of now.  Nothing of the staged table is read."""
    base, newest = _kept(spark, lake)
    if base is None:
        raise ValueError("the marts have not been built")
    income = spark.read.schema(schemas.STAGED_INCOME).parquet(lake.staged_income)
    agency, resolution, hours = (
        kept.held(spark, kept_path(lake, mart), mart, base, newest) for mart in kept.ALL
    )
    by_agency = kept.agency_efficiency(agency)
    by_income = kept.income_resolution(resolution, income)
    hotspots = kept.complaint_hotspots(hours, income)
    points = dashboard.income_scatter(by_income)
    found = (
        by_agency,
        by_income,
        hotspots,
        points,
        dashboard.income_trendline(points),
        dashboard.avg_resolution_by_borough(by_agency),
        dashboard.agency_ranking(by_agency),
        dashboard.types_by_borough(hotspots),
    )
    return dict(zip(MARTS, found, strict=True))


MARTS = (
    "fct_agency_efficiency",
    "fct_income_resolution",
    "fct_complaint_hotspots",
    "chart_income_scatter",
    "chart_income_trendline",
    "chart_resolution_by_borough",
    "chart_agency_ranking",
    "chart_types_by_borough",
)


def publish_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Bring the marts up to date, and offer them and the stored layers as views of this session."""
    build_marts(spark, lake)
    staged = staged_complaints(spark, lake)
    income = spark.read.schema(schemas.STAGED_INCOME).parquet(lake.staged_income)
    tables = {
        "raw_complaints": read_silver(spark, lake.silver_complaints),
        "raw_median_income": spark.read.parquet(lake.silver_income),
        "stg_complaints": staged,
        "stg_median_income": income,
        "complaints_snapshots": read_history(spark, lake.history, schemas.HISTORY),
    }
    tables |= read_marts(spark, lake)
    return {name: register_mart(name, table) for name, table in tables.items()}


def run_daily(
    spark: SparkSession,
    lake: Lake,
    run: str,
    at: datetime | None = None,
    full_refresh: bool = False,
    granularity: str = "day",
    strict: bool = False,
) -> dict[str, DataFrame]:
    """Everything after the extract, in order.  History and marts are only touched when the
    checks pass.

    Raw files are taken by the checkpoint of the load, whatever their times.  Rows without a key
    are stored under the run's name and fail the checks."""
    prepare(spark)
    stream_silver(
        spark, lake.bronze_complaints, lake.silver_complaints, lake.silver_checkpoint, at=at
    ).awaitTermination()
    load_income(spark, lake)
    left_out = build_staging(spark, lake, full_refresh, granularity, run)
    check_staging(spark, lake, strict, left_out)
    take_history(spark, lake, run, full_refresh, granularity)
    return publish_marts(spark, lake)
