"""Times, rows and sets that several tests build or compare."""

from __future__ import annotations

from datetime import date, datetime, timezone

from civicspark import schemas


def at(text: str) -> datetime:
    """UTC instant as a collected Spark timestamp shows it here (zone-less local time)."""
    instant = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return instant.astimezone().replace(tzinfo=None)


def silver_frame(spark, rows: list[dict]):
    """Silver rows from dicts; columns not given are null, times are ISO text."""
    values = []
    for row in rows:
        record = []
        for field in schemas.SILVER_COMPLAINT:
            value = row.get(field.name)
            if isinstance(value, str) and field.dataType.typeName() == "timestamp":
                value = at(value)
            if isinstance(value, str) and field.dataType.typeName() == "date":
                value = date.fromisoformat(value)
            record.append(value)
        values.append(tuple(record))
    return spark.createDataFrame(values, schemas.SILVER_COMPLAINT)


def as_set(df) -> set[tuple]:
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows)), "repeated rows"
    return set(rows)
