"""Date and time expressions.  The session zone must be UTC (see ``session.prepare``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolution_days(status: Column, closed: Column, created: Column) -> Column:
    """Calendar days from creation to closing; null unless the raw status is exactly Closed.

    Negative spans are kept."""
    return F.when(status == "Closed", F.datediff(closed, created))


def sla_days(due: Column, created: Column) -> Column:
    """Calendar days allowed for the request; null when either date is missing."""
    return F.datediff(due, created)


def ingest_date(stamp: Column) -> Column:
    return F.to_date(stamp)


def month_of(instant: Column) -> Column:
    return F.date_trunc("month", instant)


def run_stamp(instant: Column) -> Column:
    """Instant as the compact UTC text that names a run."""
    return F.date_format(instant, "yyyyMMdd'T'HHmmss'Z'")
