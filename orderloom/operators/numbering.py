"""Sequence numbers that continue earlier ones, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.codes import numbered, trailing_number
from orderloom.session import materialize

# A monotonically increasing id keeps the position inside its partition in the low 33 bits.
POSITION_BITS = 33


def equal_keys(names: dict[str, str]) -> Column:
    """Join condition ``left name <=> right name``, under which null equals null."""
    condition = F.lit(True)
    for left, right in names.items():
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


def number_rows(
    df: DataFrame, order: Sequence[str], groups: Sequence[str] = (), name: str = "sequence"
) -> DataFrame:
    """Exact 1..n numbers per group in ``order``, however large one group is.

    Rows are range-partitioned on group and order together, so a hot group spreads over many
    tasks; the sorted rows are written once with their slot, and the count of rows a group has
    in earlier partitions is added to the position inside the partition. Every size takes this
    path. ``order`` must end in a unique column, else equal rows have no defined order.
    """
    keys = [*groups, *order]
    placed = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", POSITION_BITS)),
        "numbering",
    )
    # One row per group and partition: at most groups + partitions rows in all.
    spans = placed.groupBy(*groups, "_part").agg(
        F.count("*").alias("_rows"), F.min("_slot").alias("_first")
    )
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    renamed = {name: f"_offset_{name}" for name in (*groups, "_part")}
    offsets = spans.withColumn("_shift", shift).withColumnsRenamed(renamed)
    if not groups:
        # One row per partition: bounded by the partition count, whatever the data size.
        offsets = F.broadcast(offsets)
    joined = placed.join(offsets, equal_keys(renamed), "inner")
    number = (F.col("_slot") + F.col("_shift") + 1).cast("bigint")
    return joined.select(*df.columns, number.alias(name))


def last_sequence(
    existing: DataFrame,
    code: str,
    groups: Sequence[str] = (),
    pattern: str = r"(\d+)$",
    strict: bool = False,
) -> DataFrame:
    """The greatest assigned number, 0 when nothing is assigned, overall or per group.

    Tolerant by default: codes without a number are passed over unless none has one.
    ``strict`` fails on the first code that has none. Null codes are unassigned either way.
    """
    number = trailing_number(F.col(code), pattern)
    coded = F.count(code)
    readable = F.count(number)
    broken = (coded != readable) if strict else ((coded > 0) & (readable == 0))
    message = F.lit(f"No sequence number can be read from existing {code} values.")
    value = F.when(broken, F.raise_error(message)).otherwise(F.coalesce(F.max(number), F.lit(0)))
    grouped = existing.groupBy(*groups) if groups else existing
    return grouped.agg(value.cast("bigint").alias("last_number"))


def assign_codes(
    keys: DataFrame,
    existing: DataFrame | None,
    key: str,
    code: str,
    prefix: str,
    width: int,
    strict: bool = False,
) -> DataFrame:
    """``key -> code`` for all keys: known ones keep their code, new ones continue in key order.

    Null keys get no code. ``keys`` must hold each key once.
    """
    keys = keys.where(F.col(key).isNotNull())
    if existing is None:
        fresh, last = keys, F.lit(0)
    else:
        existing = existing.where(F.col(code).isNotNull())
        fresh = keys.join(existing.select(key), key, "left_anti")
        last = last_sequence(existing, code, strict=strict).scalar()
    added = number_rows(fresh, [key], name="_n").withColumn(
        code, numbered(F.lit(prefix), F.col("_n") + last, width)
    ).drop("_n")
    return added if existing is None else existing.select(added.columns).unionByName(added)
