"""What the physical plans must look like for the work to hold at scale."""

from __future__ import annotations

import contextlib
import glob
import io
import os
import re
import time

import pyarrow.parquet as pq
import pytest
from helpers import as_set, at, silver_frame
from pyspark.sql import functions as F

from civicspark.fixtures import TIE_BREAK, Views
from civicspark.operators.dedup import latest_per_key
from civicspark.operators.history import scd2_apply, stage_history
from civicspark.operators.joins import left_join
from civicspark.operators.quality import staging_summary
from civicspark.operators.ranking import top_k
from civicspark.operators.upsert import merge_into, merge_upsert
from civicspark.plans import marts
from civicspark.plans.staging import since_last_ingest, stage_complaints
from civicspark.schemas import VALID_FROM, VERSION_ID
from civicspark.session import (
    INITIAL_PARTITIONS,
    materialize,
    own_session,
    prepare,
    shared_dir,
    size_shuffles,
    stage_table,
)
from civicspark.sinks.buckets import write_buckets
from civicspark.sinks.tables import (
    append_silver,
    laid_out,
    overwrite_table,
    with_layout_column,
    write_layout,
    write_ndjson,
)
from civicspark.sources.extract import after_cursor
from civicspark.sources.files import (
    file_facts,
    path_exists,
    read_lines,
    read_silver,
    rejected_line,
    silver_mark,
)

FOLDER = "/root/testdata/sf0.01"


def plan(df, mode="formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def nodes(df, name: str) -> int:
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"[-+ :]{name} ", tree))


@pytest.fixture(scope="module")
def views(spark):
    return Views(spark, FOLDER)


def test_incremental_slice_prunes_partitions(spark, folder):
    days = [{"unique_key": d, "ingest_date": d} for d in ("2025-01-01", "2025-01-02")]
    append_silver(silver_frame(spark, days), folder)
    silver = read_silver(spark, folder)
    text = plan(since_last_ingest(silver, stage_complaints(silver)))
    assert re.search(r"PartitionFilters: \[.*ingest_date.*>=.*[sS]ubquery", text)


def test_latest_version_is_limited_before_its_shuffle(views):
    df = latest_per_key(views.versions, "unique_key", ":updated_at", TIE_BREAK)
    tree = plan(df).split("\n\n")[0]
    assert nodes(df, "Exchange") == 1 and nodes(df, "WindowGroupLimit") == 2
    # Outermost first: final limit, shuffle, partial limit.
    found = re.findall(r"WindowGroupLimit|Exchange", tree)
    assert found == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_top_k_is_not_a_global_sort(views):
    df = top_k(views.table("events"), "event_type")
    assert nodes(df, "TakeOrderedAndProject") == 1 and nodes(df, "Sort") == 0


def test_income_mart_aggregates_before_the_join(views):
    tree = plan(marts.income_resolution(views.staged(), views.income)).split("\n\n")[0]
    join = tree.index("BroadcastHashJoin Inner")
    assert "HashAggregate" not in tree[:join] and "HashAggregate" in tree[join:]


def test_hourly_profile_reads_the_requests_once(views):
    text = plan(marts.hourly_profile(views.hourly, views.income))
    assert len(re.findall(r"Location: .*events\.parquet", text)) == 1


def test_marts_read_only_their_columns(views):
    text = plan(marts.agency_efficiency(views.staged("place")))
    schema = re.search(r"ReadSchema: (struct<[^>]*l_orderkey[^>]*>)", text).group(1)
    assert "l_discount" not in schema and "l_tax" not in schema
    assert "supplier.parquet" not in text and "part.parquet" not in text


def test_cursor_and_floor_reach_the_scan(spark, folder, views):
    views.raw().limit(10).write.parquet(f"{folder}/raw")
    text = plan(after_cursor(spark.read.parquet(f"{folder}/raw"), "2025-01-05T00:00:00Z"))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "GreaterThan(`:updated_at`" in pushed
    assert "GreaterThanOrEqual(created_date" in pushed


def test_checks_take_one_scan_and_one_shuffle_of_rows(spark, folder, views):
    staged = materialize(views.staged(), "plans")
    df = staging_summary(staged)
    text = plan(df)
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 1
    assert len(re.findall(r"hashpartitioning", text)) == 1


def test_layout_lets_adaptive_execution_split_hot_partitions(views):
    text = plan(laid_out(with_layout_column(views.staged("place", "kind"))))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_file_facts_do_not_read_files(spark, folder):
    spark.range(40).write.option("maxRecordsPerFile", 1).parquet(f"{folder}/t")
    assert silver_mark(spark, f"{folder}/t") is not None
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert file_facts(spark, f"{folder}/t", F.count("*"))[0] == 40
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == usual
    files = spark.read.format("binaryFile").load(f"{folder}/t")
    latest = plan(files.selectExpr("max(modificationTime)"))
    assert "content" not in re.search(r"ReadSchema: (.*)", latest).group(1)


def test_shuffles_follow_the_input_size(spark, folder, monkeypatch):
    import civicspark.session as session

    days = spark.range(20_000).selectExpr("id", "id % 100 AS day")
    days.repartition("day").write.partitionBy("day").parquet(f"{folder}/t")
    whole = spark.read.parquet(f"{folder}/t")
    monkeypatch.setattr(session, "BYTES_PER_REDUCER", 1000)
    own = session.own_session(spark)
    size_shuffles(own, whole)
    large = int(own.conf.get(INITIAL_PARTITIONS))
    size_shuffles(own, whole.filter("day = 7"))
    assert large > 50 and int(own.conf.get(INITIAL_PARTITIONS)) <= large // 20
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_staged_things_are_released(spark, folder):
    import civicspark.session as session

    name = session.stage_table(spark.range(3), "mine")
    path = session.scratch_path(spark, "mine")
    spark.range(3).write.parquet(path)
    session.release(spark)
    assert not spark.catalog.tableExists(name)
    assert not path_exists(spark, path)


def test_hotspots_run_nothing_while_they_are_built(spark, views):
    from civicspark.plans import marts

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("hotspots", "")
    try:
        marts.complaint_hotspots(views.staged("place", "kind"), views.income)
        assert not tracker.getJobIdsForGroup("hotspots")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_of_a_merge_do_not_grow_with_its_partitions(spark, folder):
    from helpers import as_set, at, silver_frame

    from civicspark.operators.upsert import merge_into
    from civicspark.plans.staging import KEY, UPDATED, stage_complaints

    def batch(keys, month):
        rows = [{"unique_key": str(k), "created_date": f"2025-{month:02}-{k + 1:02}",
                 ":updated_at": f"2025-{month:02}-{k + 1:02}"} for k in range(keys)]
        return stage_complaints(silver_frame(spark, rows))

    def jobs_of(keys):
        path = f"{folder}/{keys}"
        merge_into(spark, path, batch(keys, 1), KEY, UPDATED)
        spark.sparkContext.setJobGroup(f"merge{keys}", "")
        # every row moves, so every partition is emptied
        merge_into(spark, path, batch(keys, 2), KEY, UPDATED)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert spark.read.parquet(path).count() == keys
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"merge{keys}"))

    assert jobs_of(3) == jobs_of(24)


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: default)})
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)


@contextlib.contextmanager
def settings(spark, **values):
    before = {name: spark.conf.get(name.replace("__", "."), None) for name in values}
    for name, value in values.items():
        spark.conf.set(name.replace("__", "."), value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name.replace("__", "."))
            else:
                spark.conf.set(name.replace("__", "."), value)


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "128k",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
    INITIAL_PARTITIONS: "16",
}


def hot_rows(spark, rows=60_000):
    """Rows of which a third share one key; the text keeps them from being compressed away."""
    return spark.range(rows, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("text"),
        "id",
    )


def test_a_hot_join_key_is_split(spark):
    with settings(spark, **SMALL):
        right = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
        joined = left_join(hot_rows(spark), right, ["k"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined, "simple")


def test_a_hot_day_is_written_as_several_files(spark, folder):
    with settings(spark, **SMALL):
        rows = hot_rows(spark).select(
            "text",
            F.col("id").cast("string").alias("borough"),
            F.lit("t").alias("complaint_type"),
            F.lit("z").alias("incident_zip"),
            F.when(F.col("k") == 7, F.lit("2025-01-01"))
            .otherwise(F.concat(F.lit("2025-02-0"), 1 + F.col("id") % 9))
            .cast("timestamp")
            .alias("created_date"),
        )
        write_layout(rows, folder)
    files = {part: len([n for n in os.listdir(f"{folder}/{part}") if n.endswith(".parquet")])
             for part in os.listdir(folder) if part.startswith("created_part")}
    assert len(files) == 7
    assert files["created_part=2025-01-01"] >= 8
    assert spark.read.parquet(folder).count() == 60_000


def test_newer_only_merge_shuffles_the_batch_once(spark):
    rows = [("a", 2, "x"), ("a", 2, "y"), ("b", 1, "z")]
    held = spark.createDataFrame([("a", 2, "old"), ("b", 3, "kept")], "id string, t int, v string")
    merged = merge_upsert(
        held, spark.createDataFrame(rows, held.schema), "id", "t", ["v"], newer_only=True
    )
    assert nodes(merged, "Exchange") == 1
    assert as_set(merged) == {("a", 2, "y"), ("b", 3, "kept")}


def test_version_ids_are_not_shuffled(spark):
    held = spark.createDataFrame([("a", at("2024-01-01"), "x")], "id string, t timestamp, v string")
    first = scd2_apply(None, held, "id", "t")
    later = held.withColumn("t", F.col("t") + F.expr("INTERVAL 1 DAY"))
    grown = scd2_apply(first, later, "id", "t")
    ids = F.md5(F.concat_ws("|", "id", F.col(VALID_FROM).cast("string")))
    assert grown.filter(F.col(VERSION_ID) == ids).count() == 2
    assert "md5(" not in plan(grown, "simple").split("Join", 1)[1]


def test_lines_are_parsed_once_however_often_the_record_is_asked(spark, folder):
    spark.createDataFrame([('{"unique_key": "1"}',), ("{bad",)], "value string").write.text(f"{folder}/lines")
    rows = read_lines(spark, f"{folder}/lines")
    bad = rows.filter(rejected_line()).select("value", "record.unique_key")
    assert bad.count() == 2
    assert plan(bad, "simple").count("from_json(") == 1


def test_a_merge_shuffles_the_batch_once_and_the_stored_table_never(spark, folder):
    from civicspark.operators.upsert import _merge_latest
    from civicspark.plans.staging import KEY, UPDATED
    from civicspark.sinks.buckets import bucket_count, dealt_into, read_buckets
    from civicspark.sinks.tables import CLUSTER_COLUMNS

    def batch(keys, day):
        rows = [{"unique_key": str(k), "created_date": "2025-01-05", ":updated_at": day} for k in keys]
        return stage_complaints(silver_frame(spark, rows))

    path = f"{folder}/staged"
    merge_into(spark, path, batch(range(50), "2025-02-01"), KEY, UPDATED)
    buckets = bucket_count(spark, path)
    files = os.listdir(f"{path}/created_part=2025-01-05")
    assert buckets and len([name for name in files if name.endswith(".parquet")]) <= buckets
    latest = latest_per_key(with_layout_column(batch(range(40, 60), "2025-02-02")), KEY, UPDATED)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert nodes(latest, "Exchange") == 1
        with dealt_into(latest, buckets):
            staged = spark.table(stage_table(latest, "batch", KEY, buckets))
        held = read_buckets(spark, path, staged.schema, KEY, CLUSTER_COLUMNS)
        merged = _merge_latest(held, staged, KEY, UPDATED, False)
        assert nodes(merged, "Exchange") == 0
        assert merged.count() == 60
        # keys in hash tables spare the sort of the stored rows
        hashed = _merge_latest(held, staged, KEY, UPDATED, False, hashed=True)
        assert nodes(hashed, "Exchange") == nodes(hashed, "Sort") == 0 < nodes(merged, "Sort")
        assert as_set(hashed) == as_set(merged)
    # a batch that is merged again finds its rows
    for _ in range(2):
        merge_into(spark, path, batch(range(40, 60), "2025-02-02"), KEY, UPDATED)
    assert spark.read.parquet(path).count() == 60


def test_texts_of_line_items_are_made_after_the_joins(views):
    text = plan(views.silver("place", "agency", "kind"), "simple")
    assert "concat_ws" in text
    # the plan is printed from its end
    assert text.rindex("concat_ws") < text.index("Join")


def shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_writes_and_steps_leave_no_shuffle_files(spark, folder):
    rows = spark.range(1000).groupBy((F.col("id") % 100).cast("string").alias("unique_key")).count()
    step = own_session(spark).range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    day = with_layout_column(rows.withColumn("created_date", F.lit("2025-01-01").cast("timestamp")))
    for run in (
        lambda: materialize(rows, "rows"),
        lambda: overwrite_table(rows, f"{folder}/rows"),
        lambda: write_ndjson([rows], f"{folder}/lines", "run"),
        lambda: write_buckets(day, f"{folder}/buckets", "unique_key", ["unique_key"], 2),
        step.collect,
    ):
        before = shuffle_files(spark)
        run()
        # they are deleted in the background
        for _ in range(100):
            if not shuffle_files(spark) - before:
                break
            time.sleep(0.1)
        assert not shuffle_files(spark) - before
    assert spark.table(stage_table(rows, "rows")).count() == rows.count() == 100
    assert len(rows.collect()) == len(rows.collect()) == 100


def test_a_staged_history_is_not_shuffled_for_the_next_snapshot(spark):
    times = [(str(k), at("2025-01-01"), "open") for k in range(40)]
    current = spark.createDataFrame(times, "k string, updated timestamp, status string")
    later = current.withColumn("updated", F.col("updated") + F.expr("INTERVAL 1 DAY"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        name = stage_history(None, current, "k", "updated")
        for _ in range(2):
            grown = scd2_apply(spark.table(name), later, "k", "updated")
            assert nodes(grown, "Exchange") == 1  # that of the snapshot
            name = stage_history(name, later, "k", "updated")
            assert spark.table(name).count() == 80


def test_layers_are_encoded_cheaply(spark, folder):
    prepare(spark)
    rows = [{"unique_key": str(k), "bbl": str(k), "city": "C", ":updated_at": "2025-01-01"} for k in range(9)]
    append_silver(silver_frame(spark, rows).coalesce(1), folder)
    (file,) = glob.glob(f"{folder}/*/*.parquet")
    stored = pq.ParquetFile(file)
    names = stored.schema_arrow.names
    kinds = {stored.schema.column(k).physical_type for k, n in enumerate(names) if n.endswith("_at")}
    assert kinds == {"INT64"}
    group = stored.metadata.row_group(0)
    with_dictionary = {
        n for k, n in enumerate(names) if any("DICTIONARY" in e for e in group.column(k).encodings)
    }
    assert "city" in with_dictionary and not with_dictionary & {"unique_key", "bbl"}


def test_a_partition_is_emptied_though_a_passed_over_row_points_to_it(spark, folder):
    def merge(rows):
        frame = spark.createDataFrame(rows, "k string, t string, d string")
        frame = frame.select("k", "t", F.col("d").cast("timestamp").alias("created_date"))
        merge_into(spark, folder, frame, "k", "t", newer_only=True, cluster=["k"])

    merge([("a", "9", "2025-01-02"), ("b", "1", "2025-01-01")])
    merge([("a", "5", "2025-01-01"), ("b", "2", "2025-01-03")])
    found = spark.read.parquet(folder).select("k", "t").collect()
    assert sorted(map(tuple, found)) == [("a", "9"), ("b", "2")]
