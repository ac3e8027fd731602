"""Coded dates: eight-digit days, six-digit days with a lost zero, and shape checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.codes import zero_pad

# Accepted shapes and the year from which two digits mean the 1900s.
DAY_SHAPE = r"^[0-9]{8}$"
SHORT_DAY_SHAPE = r"^[0-9]{5,6}$"
CENTURY_PIVOT = "70"


def day(column: Column) -> Column:
    """yyyyMMdd to DATE, null when it is no such day."""
    return F.try_to_date(column, "yyyyMMdd")


def day_or_unavailable(number: Column) -> Column:
    """Numeric yyyyMMdd to DATE, where 0 stands for an unavailable day."""
    return day(F.nullif(number, F.lit(0)).cast("string"))


def checked_day(column: Column) -> Column:
    """yyyyMMdd to DATE only when all eight characters are digits."""
    return F.when(column.rlike(DAY_SHAPE), day(column))


def checked_short_day(column: Column) -> Column:
    """MMddyy to DATE: shape first, then the lost zero and the century are put back."""
    padded = zero_pad(column, 6)
    two_digit_year = F.substring(padded, 5, 2)
    century = F.when(two_digit_year >= CENTURY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    text = F.concat(century, two_digit_year, F.substring(padded, 1, 4))
    return F.when(column.rlike(SHORT_DAY_SHAPE), day(text))
