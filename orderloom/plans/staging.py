"""Typed staging views, their data tests and the investigation queries.

Every function takes the published rows and returns a DataFrame. A data test returns its
violations: no rows means it passed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.dates import day, day_or_unavailable
from orderloom.functions.text import is_blank
from orderloom.operators.guards import GuardError, repeated_keys
from orderloom.operators.repeats import repeated_rows

BUSINESS_KEY = ("company_code", "order_number", "unique_sku_code")
SOURCE_POSITION = ("source_filename", "source_file_row_number")
INVENTORY_KEY = ("snapshot_date", "warehouse_code", "full_sku_code", "pallet_number")
ORDER_PO_SKU = ("order_number", "purchase_order_number", "full_sku_code")
LINE_KEY = ("company_code", "order_number", "purchase_order_number", "full_sku_code")
OPEN_ORDER_DATES = ("order_date", "scheduled_ship_date", "customer_requested_date", "revised_delivery_date")
OPEN_ORDER_MEASURES = (
    "final_order_quantity", "shipped_order_quantity", "estimated_order_weight", "shipped_order_weight",
)
HISTORY_QUANTITIES = {
    "ordered_quantity": "ordered_quantity",
    "secondary_order_quantity": "secondary_quantity",
    "final_order_quantity": "final_quantity",
    "shipped_order_quantity": "shipped_quantity",
    "quantity_short": "quantity_short",
}
# Columns with a declared not-null test, per staging view.
NOT_NULL = {
    "stg_open_orders": (
        "company_code", "order_number", "unique_sku_code", "source_filename", "source_file_row_number",
    ),
    "stg_order_history": ("source_filename", "source_file_row_number"),
}
_STAGE_TIMES = {
    "ingested_at_datetime": "source_ingested_at",
    "standardized_at": "standardized_at",
    "pseudonymized_at": "pseudonymized_at",
}
# The load-scan moment gets a name of its own; it is neither the intake nor a business time.
_LINEAGE = {
    "source_filename": "source_filename",
    "source_file_row_number": "source_file_row_number",
    "source_file_last_modified": "source_file_last_modified",
    "ingested_at": "loaded_at",
}


# --- views --------------------------------------------------------------------------------


def stg_order_history(raw: DataFrame) -> DataFrame:
    """One row per loaded record; order_amount stays behind, it is no business fact."""
    same = (
        *BUSINESS_KEY[:2], "purchase_order_number", "customer_name",
        "full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category",
        "delivery_route", "order_type", "order_status",
        "order_date", "scheduled_ship_date", "shipped_date",
        *HISTORY_QUANTITIES, "shipped_order_weight",
        "original_product_description_removed", "original_product_category_removed",
        "original_customer_name_removed", "original_sku_codes_removed",
        "original_purchase_order_number_removed", "original_company_code_removed",
        "batch_id", "row_hash",
    )
    return raw.select(*same, *_renamed(_STAGE_TIMES), *_renamed(_LINEAGE))


def stg_open_orders(raw: DataFrame) -> DataFrame:
    """One row per loaded record: identifiers as text, coded dates as days, 0 as no date."""
    return raw.select(
        "company_code", "customer_name", "purchase_order_number",
        F.col("order_number").cast("string").alias("order_number"),
        "order_type",
        F.col("order_status").cast("string").alias("order_status"),
        "full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category",
        "product_category_derived", "delivery_route_name",
        F.col("delivery_route").cast("string").alias("delivery_route"),
        *(day_or_unavailable(F.col(name)).alias(name) for name in OPEN_ORDER_DATES),
        *OPEN_ORDER_MEASURES, "batch_id",
        "original_product_description_removed", "original_customer_name_removed", "original_sku_codes_removed",
        "original_delivery_route_name_removed", "original_purchase_order_number_removed",
        "original_company_code_removed", "row_hash",
        *_renamed(_STAGE_TIMES), *_renamed(_LINEAGE),
    )


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(source).alias(target) for source, target in names.items()]


# --- data tests ---------------------------------------------------------------------------


def assert_empty(violations: DataFrame, name: str) -> None:
    found = violations.limit(20).collect()
    if found:
        raise GuardError(f"Data test {name} failed: {found}")


def not_null_failures(view: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Columns holding nulls although declared not null, from one aggregate."""
    counters = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_rows")) for c in columns)
    )
    return view.agg(counters.alias("c")).select(F.lit(name).alias("model"), F.inline("c")).where("null_rows > 0")


def repeated_combinations(view: DataFrame, keys: Sequence[str], count_name: str) -> DataFrame:
    return repeated_keys(view, keys).withColumnRenamed("row_count", count_name)


def row_count_difference(raw: DataFrame, staging: DataFrame) -> DataFrame:
    """One row when the two counts differ; a union of marks needs no pairing of results."""
    marks = raw.select(F.lit(1).alias("r"), F.lit(0).alias("s")).unionAll(
        staging.select(F.lit(0).alias("r"), F.lit(1).alias("s"))
    )
    counted = marks.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw_rows"), F.coalesce(F.sum("s"), F.lit(0)).alias("staging_rows")
    )
    return counted.where("raw_rows <> staging_rows")


def changed_values(raw: DataFrame, staging: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Records whose listed columns differ between the published rows and the view."""
    left = raw.select(*SOURCE_POSITION, *(F.col(c).alias(f"raw_{label}") for c, label in columns.items()))
    right = staging.select(*SOURCE_POSITION, *(F.col(c).alias(f"staging_{label}") for c, label in columns.items()))
    changed = F.lit(False)
    for label in columns.values():
        changed = changed | ~F.col(f"raw_{label}").eqNullSafe(F.col(f"staging_{label}"))
    return left.join(right, list(SOURCE_POSITION)).where(changed)


def quantities_changed(raw: DataFrame, staging: DataFrame) -> DataFrame:
    return changed_values(raw, staging, HISTORY_QUANTITIES)


def measures_changed(raw: DataFrame, staging: DataFrame) -> DataFrame:
    return changed_values(raw, staging, {name: name for name in OPEN_ORDER_MEASURES})


def unexpected_date(number: Column) -> Column:
    """A given date other than 0 that is no day."""
    return number.isNotNull() & (number != 0) & day(number.cast("string")).isNull()


def dates_not_standardized(raw: DataFrame, staging: DataFrame) -> DataFrame:
    """Records missing on a side, with an impossible date, or converted otherwise than agreed."""
    left = raw.select(
        F.col("source_filename").alias("raw_file"), F.col("source_file_row_number").alias("raw_row"),
        *(F.col(name).alias(f"raw_{name}") for name in OPEN_ORDER_DATES),
    )
    right = staging.select(*SOURCE_POSITION, *OPEN_ORDER_DATES)
    joined = left.join(
        right,
        (F.col("raw_file") == F.col("source_filename")) & (F.col("raw_row") == F.col("source_file_row_number")),
        "full_outer",
    )
    broken = F.col("raw_file").isNull() | F.col("source_filename").isNull()
    for name in OPEN_ORDER_DATES:
        number = F.col(f"raw_{name}")
        broken = broken | unexpected_date(number) | ~F.col(name).eqNullSafe(day_or_unavailable(number))
    return joined.where(broken).select(
        F.coalesce("raw_file", "source_filename").alias("source_filename"),
        F.coalesce("raw_row", "source_file_row_number").alias("source_file_row_number"),
    )


# --- investigations -----------------------------------------------------------------------


def rows_per_source_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_filename").agg(F.count("*").alias("row_count"))


def batch_file_lineage(raw: DataFrame) -> DataFrame:
    return raw.groupBy("batch_id", "source_filename").agg(
        F.count("*").alias("row_count"),
        F.min("shipped_date").alias("earliest_shipped_date"),
        F.max("shipped_date").alias("latest_shipped_date"),
        F.min("pseudonymized_at").alias("earliest_privacy_processing"),
        F.max("pseudonymized_at").alias("latest_privacy_processing"),
        F.max("ingested_at").alias("latest_load_time"),
    )


def order_history_grain(raw: DataFrame) -> DataFrame:
    """Business keys that repeat, with how many shipping days they cover."""
    return raw.groupBy(*BUSINESS_KEY).agg(
        F.count("*").alias("rows_per_combination"),
        F.count_distinct("shipped_date").alias("distinct_shipped_dates"),
        F.min("shipped_date").alias("earliest_shipped_date"),
        F.max("shipped_date").alias("latest_shipped_date"),
    ).where("rows_per_combination > 1")


def order_history_repeated_rows(raw: DataFrame) -> DataFrame:
    return repeated_rows(raw, BUSINESS_KEY, "candidate_key_row_count")


def source_identity(raw: DataFrame) -> DataFrame:
    """Are file and position enough to find each row? Pairs with a null are not counted."""
    return raw.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - F.count("source_filename")).alias("missing_source_filenames"),
        (F.count("*") - F.count("source_file_row_number")).alias("missing_source_row_numbers"),
        F.count_distinct(*SOURCE_POSITION).alias("distinct_source_positions"),
    )


def candidate_key_counts(raw: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Rows against distinct key combinations, null combinations included."""
    grouped = raw.groupBy(*keys).agg(F.count("*").alias("n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_candidate_keys")
    ).select(F.lit(label).alias("source_table"), "total_rows", "distinct_candidate_keys")


def row_hash_counts(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("row_hash").alias("distinct_row_hashes"),
        F.count_if(F.col("row_hash").isNull()).alias("null_row_hashes"),
    )


def top_repeats(raw: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The most repeated keys; equal counts are ordered by the key."""
    return repeated_keys(raw, keys).orderBy(F.desc("row_count"), *keys).limit(limit)


def labelled_counts(label: str, **tables: DataFrame) -> DataFrame:
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias(label), "row_count")
              for name, df in tables.items()]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionAll(part)
    return result


def open_orders_grain(raw: DataFrame) -> DataFrame:
    """Key completeness and repeats in one row. Each grain is grouped once; the three
    one-row results meet as rows of a union."""
    complete = raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(is_blank(F.col("company_code"))).alias("missing_company_codes"),
        F.count_if(F.col("order_number").isNull()).alias("missing_order_numbers"),
        F.count_if(is_blank(F.col("unique_sku_code"))).alias("missing_unique_sku_codes"),
        F.count_if(F.col("source_filename").isNull() | F.col("source_file_row_number").isNull())
        .alias("rows_missing_source_metadata"),
    )
    keys = repeated_keys(raw, BUSINESS_KEY).agg(F.count("*").alias("duplicate_business_key_groups"))
    positions = repeated_keys(raw, SOURCE_POSITION).agg(F.count("*").alias("duplicate_source_positions"))
    return _side_by_side(
        [complete, keys, positions],
        ["total_rows", "missing_company_codes", "missing_order_numbers", "missing_unique_sku_codes",
         "duplicate_business_key_groups", "rows_missing_source_metadata", "duplicate_source_positions"],
    )


def _side_by_side(one_row_results: list[DataFrame], columns: list[str]) -> DataFrame:
    stacked = one_row_results[0]
    for part in one_row_results[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*(F.max(name).alias(name) for name in columns))


def open_orders_date_profile(raw: DataFrame) -> DataFrame:
    parsed = {name: day(F.col(name).cast("string")) for name in OPEN_ORDER_DATES}
    counters = [F.count("*").alias("total_rows")]
    counters += [F.count_if(F.col(n).isNull()).alias(f"missing_{n}s") for n in OPEN_ORDER_DATES]
    counters += [
        F.count_if(F.col(n).isNotNull() & parsed[n].isNull()).alias(f"invalid_{n}s") for n in OPEN_ORDER_DATES
    ]
    for name in OPEN_ORDER_DATES:
        counters += [F.min(parsed[name]).alias(f"earliest_{name}"), F.max(parsed[name]).alias(f"latest_{name}")]
    return raw.agg(*counters)


def invalid_open_order_dates(raw: DataFrame) -> DataFrame:
    """Records with a date that is no day, next to what was tried."""
    broken = F.lit(False)
    for name in OPEN_ORDER_DATES:
        broken = broken | (F.col(f"raw_{name}").isNotNull() & F.col(f"converted_{name}").isNull())
    return raw.select(
        *BUSINESS_KEY,
        *(F.col(n).alias(f"raw_{n}") for n in OPEN_ORDER_DATES),
        *(day(F.col(n).cast("string")).alias(f"converted_{n}") for n in OPEN_ORDER_DATES),
        *SOURCE_POSITION,
    ).where(broken)


def open_orders_staging_summary(raw: DataFrame, staging: DataFrame) -> DataFrame:
    """Row counts, zero dates before against null dates after, impossible dates."""
    short = {"order_date": "order_dates", "scheduled_ship_date": "scheduled_dates",
             "customer_requested_date": "customer_requested_dates", "revised_delivery_date": "revised_delivery_dates"}
    before = raw.agg(
        F.count("*").alias("raw_rows"),
        *(F.count_if(F.col(n) == 0).alias(f"raw_zero_{n}s") for n in OPEN_ORDER_DATES),
        *(F.count_if(unexpected_date(F.col(n))).alias(f"unexpected_invalid_{short[n]}") for n in OPEN_ORDER_DATES),
    )
    after = staging.agg(
        F.count("*").alias("staging_rows"),
        *(F.count_if(F.col(n).isNull()).alias(f"staging_null_{n}s") for n in OPEN_ORDER_DATES),
    )
    return _side_by_side([before, after], [*before.columns, *after.columns])
