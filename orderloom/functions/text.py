"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a source cleaner treats as white space.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text that means "no value" in a delimited extract.
NULL_TOKENS = ("NULL", "null", "")


def strip(column: Column) -> Column:
    """Remove white space of every kind at both ends; ``trim`` alone only removes spaces."""
    return F.btrim(column, F.lit(WHITESPACE))


def identity_text(column: Column) -> Column:
    return F.upper(strip(column))


def joined_key(*columns: Column) -> Column:
    """Parts joined by a bar; null as soon as one part is null."""
    parts: list[Column] = []
    for position, column in enumerate(columns):
        if position:
            parts.append(F.lit("|"))
        parts.append(column)
    return F.concat(*parts)


def null_if_token(column: Column) -> Column:
    """Trim spaces, then turn the null tokens of the text format into real nulls."""
    trimmed = F.trim(column)
    return F.when(~trimmed.isin(*NULL_TOKENS), trimmed)


def is_blank(column: Column) -> Column:
    return column.isNull() | (F.trim(column) == "")


def empty_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))
