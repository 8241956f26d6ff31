"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicspark.schemas import NO_DATA_CODE

# The Unicode white-space characters.  Spark's plain trim() only strips spaces.
BLANKS = (
    "\t\n\v\f\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_blank(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.trim(text, F.lit(BLANKS))


def normal_status(status: Column) -> Column:
    return F.lower(strip_blank(status))


def normal_city(city: Column) -> Column:
    return F.upper(strip_blank(city))


def income_amount(text: Column) -> Column:
    """Income text to int: the no-data code counts as 0, unreadable text as null.

    A decimal fraction is cut off first, which is what a non-ANSI cast to int does."""
    whole = F.regexp_replace(text, r"\.\d*\s*$", "")
    return F.when(text.contains(NO_DATA_CODE), F.lit(0)).otherwise(whole.try_cast("int"))
