"""File scans: raw JSON lines, Parquet, Hive-partitioned folders and external tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicspark import schemas


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that Spark uses for the path."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)


def read_complaints(
    spark: SparkSession, path: str, since: datetime | str | None = None
) -> DataFrame:
    """Raw records under the declared schema: other fields are dropped, values that do not
    parse become null, a malformed line becomes an all-null row.

    ``since`` keeps only the files modified after that instant (UTC)."""
    reader = spark.read.schema(schemas.RAW_COMPLAINT).option("recursiveFileLookup", "true")
    if since is not None:
        reader = reader.option("modifiedAfter", file_mark(since))
    return reader.json(path)


def read_lines(spark: SparkSession, path: str, file: str | None = None) -> DataFrame:
    """Every line that is not empty (``value``) and what it holds under the declared schema
    (``record``), with the text of the line if it did not parse cleanly; under the name ``file``
    also the path of its file.

    Lines are parsed as text: a JSON scan only parses the columns a query uses, and would not
    notice a bad value in another.  Each line is parsed once: as a projection, the parsing would be
    repeated in every condition on the record that is pushed below it."""
    corrupt = T.StructField(schemas.CORRUPT, T.StringType())
    schema = T.StructType([*schemas.RAW_COMPLAINT.fields, corrupt])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    source = [F.col("_metadata.file_path").alias(file)] if file else []
    parsed = F.explode(F.array(F.from_json("value", schema, options)))
    return lines.filter(F.trim("value") != "").select(*source, "value", parsed.alias("record"))


def rejected_line() -> Column:
    """Of ``read_lines``: lines that do not parse cleanly or lack a time the extract needs."""
    return (
        F.col(f"record.{schemas.CORRUPT}").isNotNull()
        | F.col("`record`.`:updated_at`").isNull()
        | F.col("record.created_date").isNull()
    )


def read_with_corrupt(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_complaints`` plus the text of every line that did not parse cleanly."""
    return read_lines(spark, path).select("record.*")


def quarantine_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines read, lines that did not parse cleanly, lines without a key."""
    return read_with_corrupt(spark, path).agg(
        F.count("*").alias("lines"),
        F.count(schemas.CORRUPT).alias("bad_lines"),
        F.count_if(F.col("unique_key").isNull()).alias("keyless_lines"),
    )


def file_mark(instant: datetime | str) -> str:
    """The instant as the UTC text the file-time options take.

    A zone-less datetime is taken as the machine's local time, which is how a collected Spark
    timestamp arrives."""
    if isinstance(instant, str):
        return instant
    return instant.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")


def file_facts(spark: SparkSession, paths: str | list[str], *facts: Column) -> Row:
    """Aggregates over the files' names, times and lengths.  The contents are pruned from the
    scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.agg(*facts).first()


def silver_mark(spark: SparkSession, path: str) -> datetime | str:
    """Latest modification time of the written files; a fixed mark when the folder does not
    exist or holds no file.  Any other failure is raised, so that it cannot turn into a full
    reload."""
    if not path_exists(spark, path):
        return schemas.MARK_MISSING
    return file_facts(spark, path, F.max("modificationTime"))[0] or schemas.MARK_EMPTY


def read_income(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The partitioned Silver folder; ``ingest_date`` comes from the folder names, so a filter
    on it prunes whole partitions."""
    stored = spark.read.schema(schemas.SILVER_COMPLAINT).parquet(path)
    return stored.select(*[f"`{name}`" for name in schemas.SILVER_COMPLAINT.names])


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing has been written there."""
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Declare the Parquet folder at ``path`` as an external table; its partition columns are
    found from the folder names."""
    spark.catalog.createTable(name, path=path, source="parquet")
    return refresh_external(spark, name)


def refresh_external(spark: SparkSession, name: str) -> DataFrame:
    """Make partitions and files added since the last call visible."""
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
