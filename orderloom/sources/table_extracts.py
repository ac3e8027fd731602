"""The three extracts, projected from the order tables at hand.

Every line item is one record of each extract: what was ordered (order history), what is
ready to pick (open orders), what lies in the slot it ships from (inventory). Only the tables
that the asked-for columns need are joined. Rules that make the data worth checking follow
from the values themselves: returned lines carry negative amounts, unspecified priorities have
no order type, low-priority orders have no dates yet, and lines without discount and tax were
exported a second time in a correction file.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.codes import zero_pad
from orderloom.functions.hashing import row_fingerprint
from orderloom.spec import (
    INVENTORY,
    INVENTORY_FINGERPRINT,
    INVENTORY_HEADERS,
    OPEN_ORDERS,
    OPEN_ORDERS_FINGERPRINT,
    OPEN_ORDERS_HEADERS,
    ORDER_HISTORY,
    ORDER_HISTORY_FINGERPRINT,
    ORDER_HISTORY_HEADERS,
)

# Runs that delivered the files, by the return flag of the line; copies came last.
RUNS = {"A": "20260901_020000", "N": "20260908_020000", "R": "20260915_032626"}
CORRECTION_RUN = "20260922_041500"
# Ingestion batches and snapshot dates, by the status of the line.
BATCHES = {"O": "20260715_181006_000001", "F": "20260708_170000_000002"}
SNAPSHOTS = {"O": "20260710", "F": "20260709"}
INGESTED = {"O": "2026-07-15T18:10:06", "F": "2026-07-08T17:00:00"}
STANDARDIZED_AT = "2026-09-15 03:20:00"
PSEUDONYMIZED_AT = "2026-09-15 03:26:45"
LOADED_AT = "2026-09-15 04:00:00"
# Orders before this day were in the extract of the previous run.
PRIOR_BEFORE = "19950701"
# Open orders up to this day were backfilled before the inventory came.
OPEN_ORDERS_BEFORE = "19960101"

ORDER_HISTORY_COLUMNS = tuple(ORDER_HISTORY_HEADERS.values())
OPEN_ORDERS_COLUMNS = tuple(OPEN_ORDERS_HEADERS.values())
INVENTORY_COLUMNS = (*INVENTORY_HEADERS.values(), "warehouse_code", "snapshot_date")
POSITION = ("source_filename", "source_file_row_number")

col, lit = F.col, F.lit
Rules = dict[str, tuple[str, Column]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by(column: str, values: dict[str, str]) -> Column:
    pairs = iter(values.items())
    key, value = next(pairs)
    choice = F.when(col(column) == key, lit(value))
    for key, value in pairs:
        choice = choice.when(col(column) == key, lit(value))
    return choice


def _yyyymmdd(column: str) -> Column:
    return F.date_format(col(column), "yyyyMMdd")


def _whole(column: str) -> Column:
    return col(column).cast("bigint")


def _measure(value: Column) -> Column:
    return value.cast("decimal(18,4)").cast("string")


def _returned() -> Column:
    return col("l_returnflag") == "R"


def _undated() -> Column:
    return col("o_orderpriority") == "5-LOW"


def _line_status() -> Column:
    return col("l_linestatus")


def _shipped() -> Column:
    return F.when(_returned(), lit(0)).otherwise(_whole("l_quantity"))


def _weight() -> Column:
    return _whole("l_quantity") * col("p_size")


def _sku_digits() -> Column:
    return F.concat(
        zero_pad(F.regexp_extract(col("p_brand"), r"(\d+)$", 1), 2), zero_pad(col("p_partkey").cast("string"), 9)
    )


def _first_half() -> Column:
    return F.substring(_sku_digits(), 1, 6)


def _unique() -> Column:
    return F.substr(_sku_digits(), lit(7))


def _full_sku() -> Column:
    return F.concat(_first_half(), lit("-"), _unique())


def _raw_customer() -> Column:
    return F.when(
        col("l_returnflag") == "N", F.concat(lit(" "), col("c_name"), lit("\t"))
    ).otherwise(F.lower(col("c_name")))


def _category() -> Column:
    return F.concat_ws(" ", col("p_type"), F.split_part(col("p_name"), lit(" "), lit(2)))


def _description() -> Column:
    return F.concat_ws(" ", col("p_name"), col("p_partkey").cast("string"))


def _number_without_zeros() -> Column:
    return F.regexp_replace(_sku_digits(), "^0+", "")


def _order_history_rules() -> Rules:
    """Column -> (letters of the tables it needs besides lineitem, expression)."""
    return {
        "company_code": ("OC", F.concat(lit("N"), zero_pad(col("c_nationkey").cast("string"), 2))),
        "source_customer_code": ("OC", col("c_custkey").cast("string")),
        "ship_to_customer_code": ("OC", (col("c_custkey") % 7).cast("string")),
        "customer_name": ("OC", _raw_customer()),
        "purchase_order_number": ("O", F.concat(lit("PO-"), col("o_orderkey").cast("string"))),
        "order_number": ("O", col("o_orderkey").cast("string")),
        "order_type": (
            "O",
            F.when(col("o_orderpriority") != "4-NOT SPECIFIED", F.substring(col("o_orderpriority"), 1, 1)),
        ),
        "order_date": ("O", _yyyymmdd("o_orderdate")),
        "scheduled_ship_date": ("", _yyyymmdd("l_shipdate")),
        "shipped_date": ("", F.regexp_replace(F.date_format(col("l_shipdate"), "MMddyy"), "^0", "")),
        "created_by_user": ("", F.concat(lit("u"), (col("l_suppkey") % 9).cast("string"))),
        "delivery_route": ("OC", col("c_nationkey").cast("string")),
        "order_status": ("O", col("o_orderstatus")),
        "ordered_quantity": ("", _whole("l_quantity").cast("string")),
        "full_sku_code": ("P", _full_sku()),
        "first_half_sku_code": ("P", _first_half()),
        "unique_sku_code": ("P", _unique()),
        "product_description": ("P", _description()),
        "secondary_order_quantity": ("", _whole("l_quantity").cast("string")),
        "final_order_quantity": ("", _whole("l_quantity").cast("string")),
        "shipped_order_quantity": ("", _shipped().cast("string")),
        "quantity_short": ("", (_whole("l_quantity") - _shipped()).cast("string")),
        "shipped_order_weight": ("P", _measure(_weight())),
        "order_amount": (
            "",
            _measure(
                F.when(_returned(), -col("l_extendedprice").cast("decimal(18,4)"))
                .otherwise(col("l_extendedprice").cast("decimal(18,4)"))
            ),
        ),
        "product_category": (
            "P", F.when(_line_status() == "F", _category()).otherwise(F.concat(lit(" "), F.lower(_category())))
        ),
        "batch_id": ("", _by("l_linestatus", BATCHES)),
        "ingested_at_datetime": ("", _by("l_linestatus", INGESTED)),
        "source_filename": (
            "",
            F.concat(
                lit("order_history/batch_id="),
                F.when(col("copy") == 1, lit(CORRECTION_RUN)).otherwise(_by("l_returnflag", RUNS)),
                lit("/"), col("file_name"),
            ),
        ),
        "source_file_row_number": ("", col("row_index") + 1),
    }


_SHARED = (
    "company_code", "source_customer_code", "ship_to_customer_code", "customer_name", "purchase_order_number",
    "order_number", "order_type", "order_status", "full_sku_code", "first_half_sku_code", "unique_sku_code",
    "product_description", "final_order_quantity", "shipped_order_quantity", "shipped_order_weight",
    "delivery_route", "batch_id", "ingested_at_datetime", "source_file_row_number",
)


def _day_or_zero(value: Column) -> Column:
    return F.when(_undated(), lit("0")).otherwise(value)


def _open_orders_rules() -> Rules:
    shared = _order_history_rules()
    return {
        **{name: shared[name] for name in _SHARED},
        "order_date": ("O", _day_or_zero(_yyyymmdd("o_orderdate"))),
        "scheduled_ship_date": ("O", _day_or_zero(_yyyymmdd("l_shipdate"))),
        "customer_requested_date": ("O", _day_or_zero(_yyyymmdd("l_shipdate"))),
        "revised_delivery_date": ("O", _day_or_zero(_yyyymmdd("l_shipdate"))),
        "estimated_order_weight": ("P", _measure(_weight())),
        "delivery_route_name": ("OCN", F.concat_ws(" - ", col("c_name"), col("n_name"))),
        "order_amount": ("", lit("0.0000")),
        "source_filename": (
            "", F.concat(lit("open_orders/batch_id="), _by("l_returnflag", RUNS), lit("/"), col("file_name"))
        ),
    }


def _inventory_rules() -> Rules:
    return {
        "raw_sku": ("P", F.when(_returned(), F.concat(_number_without_zeros(), lit(".0"))).otherwise(_number_without_zeros())),
        "product_description": ("P", _description()),
        "pallet_number": ("", col("l_orderkey").cast("string")),
        "lot_number": ("", col("l_suppkey").cast("string")),
        "slot_location": ("", col("l_linenumber").cast("string")),
        "pallet_held_flag": ("", col("l_returnflag")),
        "production_date": ("O", _yyyymmdd("o_orderdate")),
        "best_before_date": ("", _yyyymmdd("l_shipdate")),
        "reserved_quantity": ("", F.when(_line_status() == "O", _whole("l_quantity")).otherwise(lit(0)).cast("string")),
        "quantity_on_hand": ("", _whole("l_quantity").cast("string")),
        "weight": ("P", _measure(_weight())),
        "warehouse_code": ("S", zero_pad(col("s_nationkey").cast("string"), 2)),
        "snapshot_date": ("", _by("l_linestatus", SNAPSHOTS)),
        "full_sku_code": ("P", _full_sku()),
        "source_filename": (
            "", F.concat(lit("inventory/snapshot_date="), _by("l_linestatus", SNAPSHOTS), lit("/"), col("file_name"))
        ),
        "source_file_row_number": ("", col("row_index") + 1),
    }


def _lines(spark: SparkSession, sf_dir: str, copies: bool) -> DataFrame:
    """The line items, each as often as it was exported; one scan finds both."""
    place = (col("_metadata.file_name").alias("file_name"), col("_metadata.row_index").alias("row_index"))
    exported_twice = (col("l_discount") == 0) & (col("l_tax") == 0)
    copy = F.explode(F.when(exported_twice, F.array(lit(0), lit(1))).otherwise(F.array(lit(0)))) if copies else lit(0)
    return table(spark, sf_dir, "lineitem").select("*", *place, copy.alias("copy"))


def _project(
    spark: SparkSession, sf_dir: str, rules: Rules, columns: Iterable[str], copies: bool
) -> DataFrame:
    """Orders meet their customers before the lines do, so the many lines move once for each table they name.

    Parts come first: the text they add repeats, that of an order does not. Orders come first where only
    their date is asked for, so that lines outside a wanted time are gone before parts add their text.
    """
    columns = list(columns)
    needed = set("".join(rules[name][0] for name in columns))

    def joined(rows: DataFrame, letter: str, other: DataFrame, left: str, right: str) -> DataFrame:
        return rows.join(other, col(left) == col(right), "left") if letter in needed else rows

    named = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "part", "supplier")}
    customers = joined(named["customer"], "N", named["nation"], "c_nationkey", "n_nationkey")
    orders = joined(named["orders"], "C", customers, "o_custkey", "c_custkey")
    rows = joined(_lines(spark, sf_dir, copies), "S", named["supplier"], "l_suppkey", "s_suppkey")
    to_parts = ("P", named["part"], "l_partkey", "p_partkey")
    to_orders = ("O", orders, "l_orderkey", "o_orderkey")
    dates_only = {name for name in columns if "O" in rules[name][0]} <= {"order_date"}
    for step in (to_orders, to_parts) if dates_only else (to_parts, to_orders):
        rows = joined(rows, *step)
    return rows.select(*(rules[name][1].alias(name) for name in columns))


def order_history(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Standardized order history as text, every line item and the correction copies."""
    wanted = columns if columns is not None else (*ORDER_HISTORY_COLUMNS, *POSITION)
    return _project(spark, sf_dir, _order_history_rules(), wanted, copies=True)


def open_orders(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    wanted = columns if columns is not None else (*OPEN_ORDERS_COLUMNS, *POSITION)
    return _project(spark, sf_dir, _open_orders_rules(), wanted, copies=False)


def inventory(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    wanted = columns if columns is not None else (*INVENTORY_COLUMNS, *POSITION)
    return _project(spark, sf_dir, _inventory_rules(), wanted, copies=False)


def coded(standardized: DataFrame, headers: dict[str, str], extra: dict[str, Column] | None = None) -> DataFrame:
    """The same rows under the source system's headers, with columns it also exports."""
    back = {readable: source for source, readable in headers.items()}
    named = standardized.select(*(col(name).alias(back.get(name, name)) for name in standardized.columns))
    return named.withColumns(extra) if extra else named


def category_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maintained category list: one pseudo category per source category."""
    noun = F.split_part(col("p_name"), lit(" "), lit(2))
    return table(spark, sf_dir, "part").select(
        _category().alias("product_category"),
        F.concat_ws(" ", F.initcap(F.lower(col("p_type"))), F.initcap(noun), lit("Line")).alias("pseudo_category"),
    ).distinct()


# --- published rows -----------------------------------------------------------------------


def _published(
    standardized: DataFrame, fingerprint: tuple[str, ...], typed: dict[str, Column], flags: tuple[str, ...],
    order: tuple[str, ...],
) -> DataFrame:
    rows = standardized.withColumns({**{flag: lit(True) for flag in flags}, "row_hash": row_fingerprint(standardized.schema, fingerprint)})
    return rows.withColumns(
        {
            **typed,
            "standardized_at": lit(STANDARDIZED_AT).cast("timestamp_ntz"),
            "pseudonymized_at": lit(PSEUDONYMIZED_AT).cast("timestamp_ntz"),
            "source_file_last_modified": lit(PSEUDONYMIZED_AT).cast("timestamp_ntz"),
            "ingested_at": lit(LOADED_AT).cast("timestamp_ntz"),
        }
    ).select(*order)


def published_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order history as published: typed, with lineage. Correction copies lack some flags."""
    standardized = order_history(spark, sf_dir)
    short = zero_pad(col("shipped_date"), 6)
    shipped = F.to_date(
        F.concat(
            F.when(F.substring(short, 5, 2) >= "70", lit("19")).otherwise(lit("20")),
            F.substring(short, 5, 2), F.substring(short, 1, 4),
        ),
        "yyyyMMdd",
    )
    copied = col("source_filename").contains(CORRECTION_RUN)
    typed = {
        **{n: F.to_date(col(n), "yyyyMMdd") for n in ("order_date", "scheduled_ship_date")},
        "shipped_date": shipped,
        **{n: col(n).cast("bigint") for n in (
            "ordered_quantity", "secondary_order_quantity", "final_order_quantity", "shipped_order_quantity",
            "quantity_short")},
        **{n: col(n).cast("decimal(18,4)") for n in ("shipped_order_weight", "order_amount")},
        "ingested_at_datetime": col("ingested_at_datetime").cast("timestamp_ntz"),
        "original_company_code_removed": F.when(~copied, lit(True)),
        "original_purchase_order_number_removed": ~copied,
    }
    order = tuple(ORDER_HISTORY.published.names)
    return _published(standardized, ORDER_HISTORY_FINGERPRINT, typed, ORDER_HISTORY.privacy_flags, order)


def published_open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    standardized = open_orders(spark, sf_dir)
    typed = {
        **{n: col(n).cast("bigint") for n in OPEN_ORDERS.date_columns},
        **{n: col(n).cast("bigint") for n in ("final_order_quantity", "shipped_order_quantity")},
        **{n: col(n).cast("decimal(18,4)") for n in ("estimated_order_weight", "shipped_order_weight", "order_amount")},
        "ingested_at_datetime": col("ingested_at_datetime").cast("timestamp_ntz"),
        "product_category": lit("Unconfirmed"),
        "product_category_derived": lit(True),
    }
    order = tuple(OPEN_ORDERS.published.names)
    return _published(standardized, OPEN_ORDERS_FINGERPRINT, typed, OPEN_ORDERS.privacy_flags, order)


def published_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    standardized = inventory(spark, sf_dir, (*INVENTORY_COLUMNS, "full_sku_code", *POSITION))
    typed = {
        "snapshot_date": F.to_date(col("snapshot_date"), "yyyyMMdd"),
        **{n: col(n).cast("bigint") for n in ("reserved_quantity", "quantity_on_hand")},
        "weight": col("weight").cast("decimal(18,4)"),
        "product_category": lit("Unconfirmed"),
        "product_category_derived": lit(True),
    }
    order = tuple(INVENTORY.published.names)
    return _published(standardized, INVENTORY_FINGERPRINT, typed, INVENTORY.privacy_flags, order)
