"""Declared schemas and the names and values every layer agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "INT": T.IntegerType(),
}


def declared(fields: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; unlike Spark's own DDL parser, needs no session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Fields of a raw service-request record, with their types.
RAW_COMPLAINT = declared("""
    unique_key STRING,
    closed_date TIMESTAMP,
    created_date TIMESTAMP,
    due_date TIMESTAMP,
    resolution_action_updated_date TIMESTAMP,
    address_type STRING,
    agency STRING,
    agency_name STRING,
    bbl STRING,
    borough STRING,
    city STRING,
    community_board STRING,
    complaint_type STRING,
    council_district STRING,
    descriptor STRING,
    descriptor_2 STRING,
    incident_zip STRING,
    latitude STRING,
    location_type STRING,
    longitude STRING,
    police_precinct STRING,
    status STRING,
    :created_at TIMESTAMP,
    :updated_at TIMESTAMP
""")

# Silver = raw + derived day counts + the ingest stamp (ingest_date is the partition column).
SILVER_COMPLAINT = T.StructType(
    RAW_COMPLAINT.fields
    + declared(
        "resolution_time_days INT, SLA_days INT, ingest_timestamp TIMESTAMP, ingest_date DATE"
    ).fields
)

# Columns of the staged table; the two system columns lose their colon.
STAGED_COLUMNS = (
    "unique_key status closed_date created_date due_date resolution_action_updated_date "
    "SLA_days resolution_time_days address_type agency agency_name bbl borough city "
    "community_board complaint_type council_district descriptor descriptor_2 incident_zip "
    "location_type police_precinct created_at updated_at ingest_date ingest_timestamp"
).split()
SYSTEM_COLUMNS = {":created_at": "created_at", ":updated_at": "updated_at"}
_SILVER_TYPES = {SYSTEM_COLUMNS.get(f.name, f.name): f.dataType for f in SILVER_COMPLAINT}
STAGED_COMPLAINT = T.StructType([T.StructField(n, _SILVER_TYPES[n]) for n in STAGED_COLUMNS])

# The census extract's header and what each column is called here.
INCOME_NAMES = {
    "NAME": "name",
    "S1901_C01_012E": "median_income",
    "zip code tabulation area": "zip_code",
}
SILVER_INCOME = declared("name STRING, median_income INT, zip_code STRING")
STAGED_INCOME = declared("zip_code STRING, median_income INT")
NO_DATA_CODE = "-666666"

# Statuses the staged table may hold.
ACCEPTED_STATUSES = (
    "open",
    "closed",
    "pending",
    "in progress",
    "assigned",
    "started",
    "unspecified",
)

# First-run cursor and the earliest creation date ever extracted.
FIRST_CURSOR = "2025-01-01T00:00:00.000Z"
CREATED_FLOOR = "2025-01-01T00:00:00"

# File marks for "nothing written yet" and "folder without files".
MARK_MISSING = "1970-01-01T00:00:00"
MARK_EMPTY = "2025-01-01T00:00:00"

PAGE_SIZE = 50_000
CORRUPT = "_corrupt_record"

# Columns the history table adds to the staged ones.
VALID_FROM = "dbt_valid_from"
VALID_TO = "dbt_valid_to"
VERSION_ID = "dbt_scd_id"
HISTORY = T.StructType(
    STAGED_COMPLAINT.fields
    + declared(f"{VERSION_ID} STRING, {VALID_FROM} TIMESTAMP, {VALID_TO} TIMESTAMP").fields
)
