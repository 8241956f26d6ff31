"""JSON documents shaped as an array of rows whose first row is the header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = "array<array<string>>"


def header_rows_to_table(spark: SparkSession, path: str) -> DataFrame:
    """Table of text cells from ``[[header…],[row…],…]`` documents, one or many files.

    The documents may be on one line or, as the census service sends them, have one row per
    line.  Each line is parsed on its own, so a large document is split among tasks."""
    line = F.trim("value")
    opens = line.startswith("[[")
    closed = F.regexp_replace(line, r",$", "")
    whole = F.concat(
        F.when(opens, "").otherwise("["),
        closed,
        F.when(closed.endswith("]]"), "").otherwise("]"),
    )
    rows = (
        spark.read.text(path)
        .filter(line != "")
        .select(opens.alias("opens"), F.posexplode(F.from_json(whole, ROWS)).alias("at", "cells"))
        .withColumn("is_header", F.col("opens") & (F.col("at") == 0))
    )
    first = rows.filter("is_header").select("cells").first()
    if first is None:
        raise ValueError("the documents have no header row")
    names = first.cells
    # A document with other columns must not be read under these; checked in the same pass.
    agrees = F.col("cells") == F.array(*[F.lit(name) for name in names])
    refused = F.raise_error(F.lit("the documents do not have the same header")).cast("boolean")
    is_data = F.when(~F.col("is_header"), True).when(agrees, False).otherwise(refused)
    return rows.filter(is_data).select(
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )
