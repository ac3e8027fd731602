"""Identity keys, row fingerprints and salted replacements."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import identity_text, joined_key

# Replacement alphabet, bytes per digest, and how null prints in a fingerprint.
PSEUDONYM_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
DIGEST_BYTES = 32
NULL_TEXT = "\\N"
HEX_DIGITS = "0123456789abcdef"


def require_salt(salt: str | None) -> str:
    """The salt has no default: a guessable one would defeat the replacement."""
    if salt is None or not salt.strip():
        raise ValueError("A non-blank pseudonymization salt is required.")
    return salt


def salt_column(df: DataFrame, salt: str | DataFrame) -> Column:
    """The salt as the value of a one-row table, so that no plan or setting shows it.

    ``salt`` is the secret itself or a one-row, one-column table of a protected source. Add the
    result to ``df`` as a column of its own and pass that column on.
    """
    if isinstance(salt, str) or salt is None:
        salt = df.sparkSession.createDataFrame([(require_salt(salt),)], "salt string")
    value = salt.select(F.col(f"`{salt.columns[0]}`").alias("salt"))
    blank = F.col("salt").isNull() | (F.trim("salt") == "")
    message = F.lit("A non-blank pseudonymization salt is required.")
    return value.select(F.when(blank, F.raise_error(message)).otherwise(F.col("salt"))).scalar()


def customer_key(source_code: Column, ship_to: Column, name: Column) -> Column:
    return F.md5(joined_key(identity_text(source_code), identity_text(ship_to), identity_text(name)))


def canonical_text(column: Column, data_type: T.DataType) -> Column:
    """One text form per type, so a fingerprint does not depend on the source's typing."""
    if isinstance(data_type, T.DateType):
        text = F.date_format(column, "yyyyMMdd")
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    else:  # Spark's text of a float or double is the shortest that reads back as the same number
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def row_fingerprint(schema: T.StructType, columns: Iterable[str]) -> Column:
    """md5 over the listed columns in their order; columns the input lacks are left out."""
    present = [name for name in columns if name in schema.names]
    return F.md5(
        F.concat_ws("|", *(canonical_text(F.col(f"`{name}`"), schema[name].dataType) for name in present))
    )


def short_fingerprint(column: Column) -> list[Column]:
    """A fingerprint to group by, as its 16 bytes; text of any other form stays as it is beside them."""
    formed = column.rlike(r"^[0-9a-f]{32}\z")
    return [F.when(formed, F.unhex(column)).alias("digest"), F.when(~formed, column).alias("other_text")]


def salted_hash(column: Column, salt: Column) -> Column:
    """SHA-256 of value and salt; null stays null."""
    return F.sha2(F.concat(column.cast("string"), salt), 256)


def pseudonym(column: Column, salt: Column) -> Column:
    """A stable replacement of the same length, drawn from letters and digits.

    One digest covers 32 characters. The digests are computed once per row: the one-element
    array binds them to a lambda variable instead of re-hashing for each character.
    """
    text = column.cast("string")
    length = F.length(text)
    salted = F.concat(text, salt)
    last_round = F.floor((F.greatest(length, F.lit(1)) - 1) / DIGEST_BYTES).cast("int")
    hex_text = F.array_join(
        F.transform(
            F.sequence(F.lit(0), last_round),
            lambda number: F.sha2(F.concat(salted, number.cast("string")), 256),
        ),
        "",
    )

    def nibble(digest: Column, position: Column) -> Column:
        return F.instr(F.lit(HEX_DIGITS), F.substr(digest, position, F.lit(1))) - 1

    def character(digest: Column, index: Column) -> Column:
        byte = nibble(digest, index * 2 - 1) * 16 + nibble(digest, index * 2)
        return F.substr(F.lit(PSEUDONYM_ALPHABET), byte % len(PSEUDONYM_ALPHABET) + 1, F.lit(1))

    replaced = F.get(
        F.transform(
            F.array(hex_text),
            lambda digest: F.array_join(
                F.transform(F.sequence(F.lit(1), length), lambda index: character(digest, index)), ""
            ),
        ),
        F.lit(0),
    )
    return F.when(length == 0, text).otherwise(replaced)
