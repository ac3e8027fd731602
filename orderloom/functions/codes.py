"""Readable codes: padding, numbering, prefixes and SKU shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.functions.text import empty_to_null, strip

# The formats of assigned names and codes.
CUSTOMER_PREFIX = "Customer CUST-"
ROUTE_PREFIX = "Route RT-"
SKU_PREFIX = "SKU-"
GROUP_PREFIX = "SKU-GRP-"
BASE_PREFIX = "SKU-BASE-"
PRODUCT_MARK = " Product "
NAME_WIDTH = 6
SKU_WIDTH = 6
PART_CODE_WIDTH = 5
DESCRIPTION_WIDTH = 3
UNKNOWN_CATEGORY = "Unknown Category"
UNKNOWN_SOURCE_CATEGORY = "UNKNOWN"
UNKNOWN_PREFIX = "UC"
FULL_SKU_DIGITS = 11
FIRST_HALF_DIGITS = 6
SKU_CODE_PATTERN = r"^SKU-([A-Z0-9]+)-\d+$"


def zero_pad(column: Column, width: int) -> Column:
    """Left-pad text with zeros and never cut it; plain ``lpad`` would truncate."""
    return F.lpad(column, F.greatest(F.lit(width), F.length(column)), F.lit("0"))


def numbered(prefix: Column, number: Column, width: int) -> Column:
    return F.concat(prefix, zero_pad(number.cast("string"), width))


def trailing_number(column: Column, pattern: str = r"(\d+)$") -> Column:
    """The number at the end of a code, null where the code has none."""
    return empty_to_null(F.regexp_extract(column, pattern, 1)).cast("bigint")


def sku_code_prefix(column: Column) -> Column:
    """The category prefix inside an assigned SKU code, null for any other text."""
    return empty_to_null(F.regexp_extract(column, SKU_CODE_PATTERN, 1))


def initials(column: Column) -> Column:
    words = F.split(strip(column), r"\s+")
    letters = F.upper(F.array_join(F.transform(words, lambda word: F.left(word, F.lit(1))), ""))
    return F.when(letters == "", F.lit("X")).otherwise(letters)


def full_sku_from_number(column: Column) -> Column:
    """Restore a SKU that a spreadsheet turned into a number.

    Strips, drops one trailing ``.0``, pads to eleven digits and puts the dash after six.
    """
    digits = zero_pad(F.regexp_replace(strip(column), r"\.0$", ""), FULL_SKU_DIGITS)
    return F.concat(
        F.substring(digits, 1, FIRST_HALF_DIGITS),
        F.lit("-"),
        F.substr(digits, F.lit(FIRST_HALF_DIGITS + 1)),
    )


def sku_component(column: Column, position: int) -> Column:
    """Part 0 or 1 of a dashed SKU, as text so that leading zeros stay."""
    return F.get(F.split(column, "-"), F.lit(position))
