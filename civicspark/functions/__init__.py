"""Column expressions shared by the layers; all built-in functions, no UDFs."""

from civicspark.functions.dates import (
    ingest_date,
    month_of,
    resolution_days,
    run_stamp,
    sla_days,
)
from civicspark.functions.measures import (
    average_days,
    count_where,
    is_closed,
    sum_where,
)
from civicspark.functions.text import (
    income_amount,
    normal_city,
    normal_status,
    strip_blank,
)

__all__ = [
    "average_days",
    "count_where",
    "income_amount",
    "ingest_date",
    "is_closed",
    "month_of",
    "normal_city",
    "normal_status",
    "resolution_days",
    "run_stamp",
    "sla_days",
    "strip_blank",
    "sum_where",
]
