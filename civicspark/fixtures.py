"""The general test tables seen as service requests, incomes and places (see FIXTURES.md).

Only left joins are used to add attributes, so a view without some attributes has exactly the
same rows, and a query asks only for those it needs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark import schemas
from civicspark.operators.dedup import latest_per_key
from civicspark.plans.silver import (
    clean_income,
    rename_income,
    with_resolution_days,
    with_sla_days,
)
from civicspark.plans.staging import stage_complaints

# Columns of the test tables that are read.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING",
}
NO_CITY_NATION = 24
TIE_BREAK = ["bbl"]
ATTRIBUTES = ("place", "agency", "kind")


def zip_code(customer: str) -> Column:
    """A customer key as a ZIP code: at least five digits."""
    text = F.col(customer).cast("string")
    return F.lpad(text, F.greatest(F.lit(5), F.length(text)), F.lit("0"))


def version_columns() -> dict[str, Column]:
    """What a line item says about a request version."""
    year = F.date_trunc("year", "l_shipdate")
    price = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    return {
        "unique_key": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        ":updated_at": F.col("l_shipdate"),
        "bbl": F.concat_ws("-", "l_partkey", "l_suppkey", price),
        "ingest_date": F.to_date(year),
        "ingest_timestamp": year,
    }


@dataclass(frozen=True)
class Views:
    """The tables of one folder as domain views.  Declared schemas save the inference jobs and
    read the zone-less times as UTC instants."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(TABLES[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_income(self) -> DataFrame:
        """Incomes under the census header, all cells text."""
        balance = F.col("c_acctbal")
        amount = F.when(balance < 0, "-666666666").otherwise(balance.cast("bigint").cast("string"))
        return self.table("customer").select(
            F.col("c_name").alias("NAME"),
            amount.alias("S1901_C01_012E"),
            zip_code("c_custkey").alias("zip code tabulation area"),
        )

    @cached_property
    def silver_income(self) -> DataFrame:
        return clean_income(rename_income(self.raw_income))

    @cached_property
    def income(self) -> DataFrame:
        return self.silver_income.select("zip_code", "median_income")

    def _placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` of customers with their city and borough.  Nations and regions are joined on one by
        one, for Spark to know how small they are."""
        city = F.when(
            F.col("n_nationkey") != NO_CITY_NATION,
            F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")),
        )
        nations, regions = self.table("nation"), self.table("region")
        rows = rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        rows = rows.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return rows.withColumns({"city": city, "borough": F.col("r_name")})

    @cached_property
    def places(self) -> DataFrame:
        """City and borough per customer key."""
        customers = self.table("customer").select("c_custkey", "c_nationkey")
        return self._placed(customers).select("c_custkey", "city", "borough")

    @cached_property
    def versions(self) -> DataFrame:
        """What a line item says about a request version, without any join."""
        return self.table("lineitem").select(
            *[column.alias(name) for name, column in version_columns().items()],
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_returnflag",
        )

    def _described(self, versions: DataFrame, attributes: tuple[str, ...]) -> DataFrame:
        """Silver rows: the versions (or line items, whose texts are then made after the joins and
        not shuffled) with their request's dates and status and the attributes asked for; the other
        attributes are null."""
        orders = self.table("orders")
        if "place" in attributes:
            # The few nations come last: their names would be shuffled with every row.
            customers = self.table("customer").select(
                F.col("c_custkey").alias("o_custkey"), "c_nationkey"
            )
            orders = orders.join(customers, "o_custkey", "left")
        rows = versions.join(
            orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "left"
        )
        known: dict[str, Column] = {
            "agency": F.col("l_suppkey").cast("string"),
            "incident_zip": zip_code("o_custkey"),
            "created_date": F.col("o_orderdate"),
            ":created_at": F.col("o_orderdate"),
        }
        if "agency" in attributes:
            suppliers = self.table("supplier").withColumnRenamed("s_suppkey", "l_suppkey")
            rows = rows.join(suppliers, "l_suppkey", "left")
            known["agency_name"] = F.col("s_name")
        if "kind" in attributes:
            parts = self.table("part").withColumnRenamed("p_partkey", "l_partkey")
            rows = rows.join(parts, "l_partkey", "left")
            known |= {
                "complaint_type": F.col("p_brand"),
                "descriptor": F.col("p_type"),
                "descriptor_2": F.col("p_name"),
            }
        if "place" in attributes:
            rows = self._placed(rows)
            known |= {"city": F.col("city"), "borough": F.col("borough")}
        state, flag = F.col("o_orderstatus"), F.col("l_returnflag")
        known["status"] = (
            F.when((state == "F") & (flag == "R"), " closed ")
            .when(state == "F", "Closed")
            .when(state == "O", "Open")
            .when(state == "P", "Pending")
        )
        for name, column in version_columns().items():
            known[name] = F.col(f"`{name}`") if name in versions.columns else column
        known["closed_date"] = F.when(state == "F", known[":updated_at"])
        allowed = F.make_dt_interval(F.col("l_quantity").cast("int"))
        known["due_date"] = F.when(flag != "N", F.col("o_orderdate") + allowed)
        raw = [
            known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schemas.RAW_COMPLAINT
        ]
        stamps = [known[name].alias(name) for name in ("ingest_date", "ingest_timestamp")]
        silver = rows.select(*raw, *stamps)
        return with_sla_days(with_resolution_days(silver))

    def silver(self, *attributes: str) -> DataFrame:
        """Every version of every request."""
        return self._described(self.table("lineitem"), attributes)

    def raw(self, *attributes: str) -> DataFrame:
        return self.silver(*attributes).select(*[f"`{n}`" for n in schemas.RAW_COMPLAINT.names])

    def staged(self, *attributes: str, ingested: Column | None = None) -> DataFrame:
        """The latest version of every request (among those ``ingested``), staged.  Versions
        are resolved before the attributes are joined on, so only the surviving rows are."""
        taken = self.versions if ingested is None else self.versions.filter(ingested)
        newest = latest_per_key(taken, "unique_key", ":updated_at", TIE_BREAK)
        return stage_complaints(self._described(newest, attributes))

    @cached_property
    def hourly(self) -> DataFrame:
        """Requests with a time of day, from the events."""
        places = self.places.withColumnRenamed("c_custkey", "user_id")
        return (
            self.table("events")
            .join(places, "user_id", "left")
            .select(
                F.col("event_id").cast("string").alias("unique_key"),
                F.col("event_type").alias("complaint_type"),
                F.col("ts").alias("created_date"),
                zip_code("user_id").alias("incident_zip"),
                F.upper(F.trim("city")).alias("city"),
                "borough",
            )
        )
