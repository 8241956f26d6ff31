"""Registered queries: every operator, layer and mart over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark import functions as fn
from civicspark import schemas
from civicspark.fixtures import ATTRIBUTES, TIE_BREAK, Views
from civicspark.operators import history, quality
from civicspark.operators.dedup import dedup_exact
from civicspark.operators.joins import left_join
from civicspark.operators.ranking import modal_value, top_k
from civicspark.operators.upsert import merge_into, merge_upsert
from civicspark.plans import dashboard, jobs, marts
from civicspark.plans.silver import silver_income
from civicspark.plans.staging import (
    KEY,
    UPDATED,
    positive_income,
    since_last_ingest,
    stage_complaints,
    stage_income,
    staged_latest,
)
from civicspark.session import materialize, prepare, scratch_path
from civicspark.sinks.tables import (
    LAYOUT_COLUMN,
    append_silver,
    overwrite_table,
    register_mart,
    write_layout,
    write_ndjson,
)
from civicspark.sources.extract import after_cursor, next_cursor, union_pages
from civicspark.sources.files import (
    quarantine_counts,
    read_complaints,
    read_silver,
    refresh_external,
    register_external,
)
from civicspark.sources.header_rows import header_rows_to_table
from civicspark.sources.keyset import number_slices, slice_after
from civicspark.streaming import loads

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the queries share with their SQL counterparts.
CURSOR = "1997-06-30T00:00:00"
FLOOR = "1995-06-01T00:00:00"
PAGE_START = "1996-01-01T00:00:00"
BATCH_YEAR = "1999-01-01"
SNAPSHOTS = ("1997-01-01", "1999-01-01")
AS_OF = "2003-01-01"
RUN_AT = datetime(2024, 5, 1, 12, 30, tzinfo=timezone.utc)
RUN = RUN_AT.strftime("%Y%m%dT%H%M%SZ")
HOT_TYPES = 3
MOVED, MOVED_BY = "[13579]$", "40 DAY 5 HOUR"
RAW_NAMES = [f"`{name}`" for name in schemas.RAW_COMPLAINT.names]

_registered: dict[str, Query] = {}


def _zoneless(df: DataFrame) -> DataFrame:
    """UTC instants as zone-less times, the type SQL engines compare them in."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name)
            if kind == "timestamp"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return _zoneless(build(Views(spark, folder)))

    _registered[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_registered)


def _early() -> Column:
    return F.col("ingest_date") < F.lit(BATCH_YEAR).cast("date")


# Silver --------------------------------------------------------------------------------


@query
def silver_derived_days(v: Views) -> DataFrame:
    return v.silver().select(
        KEY, "bbl", "status", "closed_date", "due_date", "resolution_time_days", "SLA_days"
    )


@query
def silver_exact_dedup(v: Views) -> DataFrame:
    return dedup_exact(v.raw().select(KEY, "status", "created_date", "incident_zip"))


@query
def income_clean_sentinel(v: Views) -> DataFrame:
    return silver_income(v.raw_income)


@query
def income_rebuilt_table(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "income")
    overwrite_table(v.raw_income, f"{path}/bronze")
    for _ in range(2):
        overwrite_table(silver_income(v.spark.read.parquet(f"{path}/bronze")), f"{path}/silver")
    return stage_income(v.spark.read.parquet(f"{path}/silver"))


@query
def header_rows_table(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "header-rows")
    cells = v.raw_income
    rows = cells.select(F.to_json(F.array(*[f"`{name}`" for name in cells.columns])).alias("row"))
    # One document per line, each a header row and one data row.
    header = F.to_json(F.array(*[F.lit(name) for name in cells.columns]))
    rows.select(F.concat(F.lit("["), header, F.lit(","), "row", F.lit("]"))).write.text(path)
    return silver_income(header_rows_to_table(v.spark, path))


@query
def ndjson_scan(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "bronze")
    write_ndjson([v.raw("place")], path, RUN, "gzip")
    return read_complaints(v.spark, path).select(
        KEY, "bbl", "status", "city", "borough", "created_date", "closed_date", "due_date",
        F.col("`:updated_at`").alias("updated_at"),
    )


@query
def ndjson_quarantine(v: Views) -> DataFrame:
    """Every request as a JSON line; pending ones have their line cut short, and requests with
    a padded status lose their key."""
    path = scratch_path(v.spark, "lines")
    raw = v.raw().withColumn(KEY, F.when(F.col("status") != " closed ", F.col(KEY)))
    line = F.to_json(F.struct(*[f"`{name}`" for name in raw.columns]))
    cut = F.when(raw.status == "Pending", F.substring(line, F.lit(1), F.length(line) - 1))
    raw.select(F.coalesce(cut, line).alias("value")).write.text(path, compression="gzip")
    return quarantine_counts(v.spark, path)


@query
def silver_partitioned_roundtrip(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "silver")
    append_silver(v.silver().filter(_early()), path)
    append_silver(v.silver().filter(~_early()), path)
    return read_silver(v.spark, path).select(
        KEY, "bbl", "status", "resolution_time_days", "SLA_days", "ingest_date"
    )


@query
def silver_two_loads(v: Views) -> DataFrame:
    """Two raw files and two loads: the second load takes only what came after the first."""
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    for run, ingested in (("early", _early()), ("late", ~_early())):
        raw = v.silver().filter(ingested).select(*RAW_NAMES)
        write_ndjson([raw], lake.bronze_complaints, run, "gzip", fast=True)
        jobs.load_silver(v.spark, lake, RUN_AT)
    return read_silver(v.spark, lake.silver_complaints).select(
        KEY, "bbl", "status", "resolution_time_days", "SLA_days", "ingest_timestamp", "ingest_date"
    )


@query
def external_table_refresh(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "external")
    name = "silver_" + path.rsplit("-", 1)[1]
    append_silver(v.silver().filter(_early()), path)
    register_external(v.spark, name, path)
    append_silver(v.silver().filter(~_early()), path)
    return (
        refresh_external(v.spark, name)
        .groupBy("ingest_date")
        .agg(F.count("*").alias("n_rows"), F.sum("SLA_days").alias("total_sla_days"))
    )


@query
def external_table_flat(v: Views) -> DataFrame:
    """An unpartitioned external table, whose files are replaced after it was declared."""
    path = scratch_path(v.spark, "external")
    name = "income_" + path.rsplit("-", 1)[1]
    overwrite_table(v.income.filter("median_income > 0"), path)
    register_external(v.spark, name, path)
    overwrite_table(v.income, path)
    return refresh_external(v.spark, name)


@query
def bronze_microseconds(v: Views) -> DataFrame:
    """Versions microseconds apart keep their order through the raw files."""
    path = scratch_path(v.spark, "bronze")
    micros = F.make_interval(secs=F.length("bbl") / 1_000_000)
    raw = v.raw().withColumn(":updated_at", F.col("`:updated_at`") + micros)
    write_ndjson([raw], path, RUN, "gzip")
    return read_complaints(v.spark, path).select(
        KEY, "bbl", F.col("`:updated_at`").alias("updated_at")
    )


# Extract -------------------------------------------------------------------------------


@query
def extract_since_cursor(v: Views) -> DataFrame:
    rows = after_cursor(v.raw(), CURSOR, FLOOR)
    return rows.select(
        KEY, "bbl", "status", "created_date", F.col("`:updated_at`").alias("updated_at")
    )


@query
def extract_next_cursor(v: Views) -> DataFrame:
    return next_cursor(after_cursor(v.raw(), CURSOR, FLOOR), CURSOR)


@query
def extract_keyset_page(v: Views) -> DataFrame:
    rows = v.versions.select(F.col("`:updated_at`").alias("updated_at"), KEY, "bbl")
    return slice_after(rows, ["updated_at", KEY, "bbl"], [PAGE_START, "", ""], 20_000)


@query
def extract_two_runs(v: Views) -> DataFrame:
    """Two extracts with a kept cursor: the second takes only what the first did not see."""
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    source = v.raw()
    seen = source.filter(F.col("`:updated_at`") <= F.lit(BATCH_YEAR).cast("timestamp"))
    for run, available in (("one", seen), ("two", source)):
        jobs.extract_complaints(v.spark, lake, available, run, CURSOR, FLOOR, "gzip")
    return read_complaints(v.spark, lake.bronze_complaints).select(
        KEY, "bbl", F.col("`:updated_at`").alias("updated_at")
    )


@query
def extract_all_pages(v: Views) -> DataFrame:
    rows = v.versions.select(F.col("`:updated_at`").alias("updated_at"), KEY, "bbl")
    return number_slices(rows, ["updated_at", KEY, "bbl"], 20_000)


@query
def extract_rejected_lines(v: Views) -> DataFrame:
    """Raw lines extracted; pending requests have their line cut short."""
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    raw = v.raw()
    line = F.to_json(F.struct(*[f"`{name}`" for name in raw.columns]))
    cut = F.when(raw.status == "Pending", F.substring(line, F.lit(1), F.length(line) - 1))
    source = f"{lake.root}/source"
    raw.select(F.coalesce(cut, line).alias("value")).write.text(source, compression="gzip")
    jobs.extract_lines(v.spark, lake, source, RUN, CURSOR, FLOOR, "gzip")
    stored = v.spark.read.option("recursiveFileLookup", "true").text(lake.bronze_complaints)
    rejected = v.spark.read.text(lake.rejected).agg(F.count("*"))
    return stored.agg(
        F.count("*").alias("fetched"), F.first(rejected.scalar()).alias("rejected")
    )


@query
def pages_union(v: Views) -> DataFrame:
    raw = v.raw()
    closed = F.col("status").isin("Closed", " closed ")
    shared = [KEY, "bbl", "status"]
    return union_pages(
        [
            raw.filter(closed).select(*shared, "closed_date"),
            raw.filter(~closed).select(*shared, "due_date"),
        ]
    )


@query
def run_stamps(v: Views) -> DataFrame:
    stamp = fn.run_stamp(F.col("ingest_timestamp")).alias("run")
    return v.versions.groupBy(stamp).agg(F.count("*").alias("n_rows"))


# Staging -------------------------------------------------------------------------------


@query
def staging_projection(v: Views) -> DataFrame:
    return stage_complaints(v.silver(*ATTRIBUTES))


@query
def staging_latest(v: Views) -> DataFrame:
    return staged_latest(v.silver(*ATTRIBUTES), TIE_BREAK)


@query
def staging_incremental_slice(v: Views) -> DataFrame:
    loaded = v.versions.filter(F.col("ingest_date") <= F.lit(BATCH_YEAR).cast("date"))
    return since_last_ingest(v.versions, loaded).select(KEY, "bbl", "ingest_date")


@query
def staging_merge_upsert(v: Views) -> DataFrame:
    target = v.staged("place", ingested=_early())
    batch = materialize(stage_complaints(v.silver("place").filter(~_early())), "batch")
    return merge_upsert(target, batch, KEY, UPDATED, TIE_BREAK)


@query
def staging_merge_late_batch(v: Views) -> DataFrame:
    """The older rows arrive last: a plain merge lets them replace newer ones."""
    target = v.staged(*ATTRIBUTES, ingested=~_early())
    batch = materialize(stage_complaints(v.silver(*ATTRIBUTES).filter(_early())), "batch")
    return merge_upsert(target, batch, KEY, UPDATED, TIE_BREAK)


@query
def staging_merge_newer_only(v: Views) -> DataFrame:
    target = v.staged(*ATTRIBUTES, ingested=~_early())
    batch = materialize(stage_complaints(v.silver(*ATTRIBUTES).filter(_early())), "batch")
    return merge_upsert(target, batch, KEY, UPDATED, TIE_BREAK, newer_only=True)


@query
def staging_merge_table(v: Views) -> DataFrame:
    """The late batch merged into a stored table, partitioned by creation month."""
    path = scratch_path(v.spark, "staged")
    for ingested in (~_early(), _early()):
        batch = stage_complaints(v.silver(*ATTRIBUTES).filter(ingested))
        merge_into(v.spark, path, batch, KEY, UPDATED, TIE_BREAK, granularity="month")
    return v.spark.read.parquet(path).drop(LAYOUT_COLUMN)


def _staged_in_two_runs(v: Views) -> jobs.Lake:
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    overwrite_table(v.silver_income, lake.silver_income)
    for ingested in (_early(), ~_early()):
        append_silver(v.silver("place").filter(ingested), lake.silver_complaints)
        jobs.build_staging(v.spark, lake, granularity="month")
    return lake


@query
def staging_incremental_job(v: Views) -> DataFrame:
    """The second run merges what was ingested since the first, over a stored table."""
    return jobs.staged_complaints(v.spark, _staged_in_two_runs(v))


@query
def staging_full_refresh(v: Views) -> DataFrame:
    """As above, then rebuilt from the whole of Silver."""
    lake = _staged_in_two_runs(v)
    jobs.build_staging(v.spark, lake, full_refresh=True, granularity="month")
    return jobs.staged_complaints(v.spark, lake)


@query
def staging_layout(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "layout")
    write_layout(v.staged("place", "kind"), path, granularity="month")
    return v.spark.read.parquet(path).select(
        LAYOUT_COLUMN, KEY, "borough", "complaint_type", "incident_zip", "created_date"
    )


@query
def staging_positive_income(v: Views) -> DataFrame:
    return positive_income(v.income)


# Checks --------------------------------------------------------------------------------


@query
def dq_unique(v: Views) -> DataFrame:
    return quality.check_unique(v.versions, KEY)


@query
def dq_not_null(v: Views) -> DataFrame:
    return quality.check_not_null(v.staged("place"), "city").select(KEY, "city", "borough")


@query
def dq_accepted_values(v: Views) -> DataFrame:
    return quality.check_accepted(v.silver(), "status")


@query
def dq_negative_income(v: Views) -> DataFrame:
    uncleaned = v.raw_income.select(
        F.col("`zip code tabulation area`").alias("zip_code"),
        F.col("S1901_C01_012E").cast("bigint").alias("median_income"),
    )
    return quality.check_negative_income(uncleaned)


@query
def dq_relationships(v: Views) -> DataFrame:
    usable = positive_income(v.income)
    return quality.check_relationship(v.staged(), "incident_zip", usable, "zip_code")


@query
def dq_income_key(v: Views) -> DataFrame:
    return quality.check_income_key(union_pages([v.income, positive_income(v.income)]))


def _flawed(v: Views) -> DataFrame:
    """Requests of which some lose their key and some have an unknown status."""
    staged = stage_complaints(v.silver())
    return staged.withColumns(
        {
            KEY: F.when(F.col("status") != "pending", F.col(KEY)),
            "status": F.when(F.col("bbl").endswith("9"), "reopened").otherwise(F.col("status")),
        }
    )


@query
def dq_summary(v: Views) -> DataFrame:
    return quality.staging_summary(_flawed(v))


@query
def gate_failed_counts(v: Views) -> DataFrame:
    """What the gate raises on flawed requests."""
    try:
        failed = quality.gate(quality.staging_summary(_flawed(v)))
    except quality.QualityError as error:
        failed = error.failed
    counts = [(name, n) for name, n in failed.items() if n]
    return v.spark.createDataFrame(counts, "failing string, n long")


# Marts ---------------------------------------------------------------------------------


@query
def agency_efficiency(v: Views) -> DataFrame:
    return marts.agency_efficiency(v.staged("place", "agency"))


@query
def income_resolution(v: Views) -> DataFrame:
    return marts.income_resolution(v.staged("place"), v.income)


@query
def complaint_hotspots(v: Views) -> DataFrame:
    return marts.complaint_hotspots(v.hourly, v.income, HOT_TYPES)


@query
def complaint_hotspots_by_kind(v: Views) -> DataFrame:
    return marts.complaint_hotspots(v.staged("place", "kind"), v.income)


@query
def hot_top_types(v: Views) -> DataFrame:
    return top_k(v.staged("kind"), "complaint_type")


@query
def hot_modal_hour(v: Views) -> DataFrame:
    events = v.hourly.select(
        "complaint_type", "borough", F.hour("created_date").alias("hour_of_day")
    )
    return modal_value(events, ["complaint_type", "borough"], "hour_of_day", "busiest_hour")


@query
def hot_left_join_nulls(v: Views) -> DataFrame:
    events = v.hourly.select("city", "borough", KEY, F.hour("created_date").alias("hour_of_day"))
    places = ["city", "borough"]
    totals = events.groupBy(*places).agg(F.count(KEY).alias("total_complaints"))
    return left_join(totals, modal_value(events, places, "hour_of_day", "busiest_hour"), places)


@query
def mart_view(v: Views) -> DataFrame:
    register_mart("fct_agency_efficiency", marts.agency_efficiency(v.staged("place", "agency")))
    return v.spark.sql(
        "SELECT borough, SUM(total_cases) AS cases, SUM(total_sla_days) AS sla_days "
        "FROM fct_agency_efficiency GROUP BY borough"
    )


# Charts --------------------------------------------------------------------------------


@query
def avg_resolution_by_borough(v: Views) -> DataFrame:
    return dashboard.avg_resolution_by_borough(marts.agency_efficiency(v.staged("place")))


@query
def agency_ranking(v: Views) -> DataFrame:
    return dashboard.agency_ranking(marts.agency_efficiency(v.staged("agency")))


@query
def types_by_borough(v: Views) -> DataFrame:
    return dashboard.types_by_borough(complaint_hotspots_by_kind(v))


@query
def income_scatter(v: Views) -> DataFrame:
    return dashboard.income_scatter(income_resolution(v))


@query
def income_trendline(v: Views) -> DataFrame:
    line = dashboard.income_trendline(income_scatter(v))
    fitted = {"slope": 9, "intercept": 6, "r2": 9, "correlation": 9}
    return line.select("points", *[F.round(n, d).alias(n) for n, d in fitted.items()])


# History -------------------------------------------------------------------------------


def _snapshots(v: Views) -> list[DataFrame]:
    """The staged table as it stood on two dates, and as it stands."""
    day = F.col("ingest_date")
    earlier = [v.staged(ingested=day <= F.lit(date).cast("date")) for date in SNAPSHOTS]
    return [*earlier, v.staged()]


def _history(v: Views) -> DataFrame:
    name = None
    for snapshot in _snapshots(v):
        name = history.stage_history(name, snapshot, KEY, UPDATED)
    return v.spark.table(name)


def _version_columns(versions: DataFrame) -> DataFrame:
    return versions.select(
        KEY, "status", "bbl", schemas.VALID_FROM, schemas.VALID_TO, schemas.VERSION_ID
    )


@query
def scd2_history(v: Views) -> DataFrame:
    return _version_columns(_history(v))


@query
def scd2_stored_history(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "snapshots")
    for run, snapshot in enumerate(_snapshots(v)):
        history.take_snapshot(
            v.spark, path, snapshot, KEY, UPDATED, f"run{run}", granularity="month"
        )
    return _version_columns(history.read_history(v.spark, path))


@query
def status_duration(v: Views) -> DataFrame:
    return history.status_duration(_history(v), F.lit(AS_OF).cast("timestamp"))


# Streams and the whole chain -----------------------------------------------------------


def _streamed_silver(v: Views) -> str:
    path = scratch_path(v.spark, "stream")
    for run, ingested in (("early", _early()), ("late", ~_early())):
        raw = v.silver("place").filter(ingested).select(*RAW_NAMES)
        write_ndjson([raw], f"{path}/bronze", run, "gzip")
        loads.stream_silver(
            v.spark, f"{path}/bronze", f"{path}/silver", f"{path}/checkpoint"
        ).awaitTermination()
    return path


@query
def stream_silver_available_now(v: Views) -> DataFrame:
    path = _streamed_silver(v)
    return v.spark.read.parquet(f"{path}/silver").select(
        KEY, "bbl", "status", "city", "resolution_time_days", "SLA_days",
        F.col("`:updated_at`").alias("updated_at"),
    )


@query
def stream_upsert(v: Views) -> DataFrame:
    path = _streamed_silver(v)
    for _ in range(2):
        loads.stream_upsert(
            v.spark,
            f"{path}/silver",
            f"{path}/staged",
            f"{path}/checkpoint-staged",
            granularity="month",
            tie_break=TIE_BREAK,
        ).awaitTermination()
    return v.spark.read.parquet(f"{path}/staged").select(
        KEY, "bbl", "status", "city", "resolution_time_days", "SLA_days", UPDATED
    )


def _day(v: Views) -> dict[str, DataFrame]:
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    overwrite_table(v.raw_income, lake.bronze_income)
    jobs.extract_complaints(v.spark, lake, v.raw(*ATTRIBUTES), RUN, FLOOR, FLOOR, "gzip")
    return jobs.run_daily(v.spark, lake, RUN, RUN_AT, granularity="month")


def _layers(published: dict[str, DataFrame]) -> DataFrame:
    """Rows and one total of each mart and of the open history."""
    measures = {
        "fct_agency_efficiency": F.sum("total_cases"),
        "fct_income_resolution": F.sum("total_complaints"),
        "fct_complaint_hotspots": F.sum("total_complaints"),
        "complaints_snapshots": F.count_if(F.col(schemas.VALID_TO).isNull()),
    }
    return union_pages(
        [
            published[name].agg(
                F.lit(name).alias("layer"), F.count("*").alias("n_rows"), total.alias("total")
            )
            for name, total in measures.items()
        ]
    )


@query
def daily_chain(v: Views) -> DataFrame:
    """Extract to marts through every stored layer; the result is a published mart."""
    return _day(v)["fct_income_resolution"]


@query
def daily_chain_layers(v: Views) -> DataFrame:
    return _layers(_day(v))


def _marts_after_moves(v: Views) -> dict[str, DataFrame]:
    """Marts built from the early requests, then brought up to date by the changes that the late
    ones make: other agencies, types and states, and for some another day and hour of creation."""
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    overwrite_table(v.silver_income, lake.silver_income)
    late = ~_early() & F.col("bbl").rlike(MOVED)
    moved = F.when(late, F.col("created_date") + F.expr(f"INTERVAL {MOVED_BY}"))
    silver = v.silver(*ATTRIBUTES).withColumn("created_date", F.coalesce(moved, "created_date"))
    for ingested in (_early(), ~_early()):
        append_silver(silver.filter(ingested), lake.silver_complaints)
        jobs.build_staging(v.spark, lake, granularity="month")
        jobs.build_marts(v.spark, lake)
    return jobs.read_marts(v.spark, lake)


@query
def kept_agency_efficiency(v: Views) -> DataFrame:
    return _marts_after_moves(v)["fct_agency_efficiency"]


@query
def kept_income_resolution(v: Views) -> DataFrame:
    return _marts_after_moves(v)["fct_income_resolution"]


@query
def kept_complaint_hotspots(v: Views) -> DataFrame:
    return _marts_after_moves(v)["fct_complaint_hotspots"]


@query
def marts_after_second_batch(v: Views) -> DataFrame:
    """Marts published, a second batch merged, marts published again."""
    lake = jobs.Lake(scratch_path(v.spark, "lake"))
    overwrite_table(v.silver_income, lake.silver_income)
    for run, ingested in enumerate((_early(), ~_early())):
        append_silver(v.silver(*ATTRIBUTES).filter(ingested), lake.silver_complaints)
        jobs.build_staging(v.spark, lake, granularity="month")
        jobs.take_history(v.spark, lake, f"run{run}", granularity="month")
        published = jobs.publish_marts(v.spark, lake)
    layers = _layers(published)
    # of the history only the open versions are compared here
    history_rows = F.when(F.col("layer") == "complaints_snapshots", F.col("total"))
    return layers.withColumn("n_rows", F.coalesce(history_rows, F.col("n_rows")))
