"""Replacing real values by their identities, and checking that it happened."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.codes import full_sku_from_number
from orderloom.functions.hashing import pseudonym, row_fingerprint, salt_column, short_fingerprint
from orderloom.functions.text import strip
from orderloom.operators.guards import (
    clean_headers,
    mapped,
    pattern_problem,
    require_columns,
    require_unique,
)
from orderloom.operators.identities import with_customer_key
from orderloom.spec import INVENTORY, OPEN_ORDERS, ORDER_HISTORY, DatasetSpec

PRODUCT_CODES = (
    "pseudo_category", "pseudo_product_description", "pseudo_full_sku_code",
    "pseudo_first_half_sku_code", "pseudo_unique_sku_code",
)

#: The one finding that does not stop a batch.
DUPLICATE = "duplicate"

# Name of the working column that carries the salt.
SALT = "_salt"

# Replaced without being read, so no lookup needs to move them.
UNREAD_PRODUCT = ("product_description", "product_category", "first_half_sku_code", "unique_sku_code")

Step = Callable[..., DataFrame]


def as_planned(rows: DataFrame, work: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The step that leaves all lookups of a batch in one lazy plan; a ``session.Relay`` stores what each makes."""
    return work(rows) if work else rows


def lookup(facts: DataFrame, mapping: DataFrame, key: str, *columns: str) -> DataFrame:
    """Left lookup on a key that is unique in the mapping.

    No hint is given: a mapping below the broadcast threshold is broadcast on its file size,
    a larger one is sort-merged, and a hot fact key is then split by the skew-join rule.
    """
    return facts.join(mapping.select(key, *columns), key, "left")


def lookup_products(facts: DataFrame, products: DataFrame) -> DataFrame:
    keyed = facts.withColumn("full_sku_code", strip(F.col("full_sku_code")))
    return lookup(keyed, products, "full_sku_code", *PRODUCT_CODES)


def lookup_customers(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """The key of a fact is always an md5: it is joined and moved as 16 bytes, and other text in the mapping fits none."""
    keyed = with_customer_key(facts).withColumn("customer_hash_key", F.unhex("customer_hash_key"))
    digest, _ = short_fingerprint(F.col("customer_hash_key"))
    mapping = customers.select(digest.alias("customer_hash_key"), "pseudo_customer_name")
    found = lookup(keyed, mapping, "customer_hash_key", "pseudo_customer_name")
    return found.withColumn("customer_hash_key", F.lower(F.hex("customer_hash_key")))


def lookup_routes(facts: DataFrame, routes: DataFrame) -> DataFrame:
    keyed = facts.withColumn("delivery_route_name", strip(F.col("delivery_route_name")))
    return lookup(keyed, routes, "delivery_route_name", "pseudo_delivery_route_name")


def _named_customers(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Facts under their customers' pseudonyms at once, so that no later lookup moves the real name or its key."""
    name = mapped(F.col("pseudo_customer_name"), F.col("customer_hash_key"), "customer")
    found = lookup_customers(facts, customers).withColumn("customer_name", name)
    return found.drop("customer_hash_key", "pseudo_customer_name")


def _named_routes(facts: DataFrame, routes: DataFrame) -> DataFrame:
    name = mapped(F.col("pseudo_delivery_route_name"), F.col("delivery_route_name"), "route name")
    return lookup_routes(facts, routes).withColumn("delivery_route_name", name).drop("pseudo_delivery_route_name")


def _checked_mapping(mapping: DataFrame, key: str, columns: tuple[str, ...], label: str) -> DataFrame:
    cleaned = clean_headers(mapping, "spaces")
    require_columns(cleaned, (key, *columns), label)
    cleaned = cleaned.withColumn(key, strip(F.col(key)))
    return require_unique(cleaned, key, label)


def salted(df: DataFrame, salt: str | DataFrame) -> DataFrame:
    """``df`` with the salt as a column, for the functions that mix it in; it never leaves this module."""
    return df.withColumn(SALT, salt_column(df, salt))


def _finish(
    facts: DataFrame,
    products: DataFrame,
    salt: str | DataFrame,
    replaced: dict[str, Column],
    added: dict[str, Column],
    output: list[str],
    spec: DatasetSpec,
    at: datetime,
) -> DataFrame:
    """Look products up and swap values, fingerprint the swapped row, keep only the listed columns."""
    swapped = salted(lookup_products(facts, products), salt).withColumns({**replaced, **added})
    return swapped.withColumn("row_hash", row_fingerprint(swapped.schema, spec.fingerprint)).select(
        *output, *added, "row_hash", F.lit(at).cast("timestamp_ntz").alias("pseudonymized_at")
    )


def _flags(*names: str) -> dict[str, Column]:
    return {f"original_{name}_removed": F.lit(True) for name in names}


def pseudonymize_order_history(
    orders: DataFrame, products: DataFrame, customers: DataFrame, salt: str | DataFrame, at: datetime,
    step: Step = as_planned,
) -> DataFrame:
    """Order history without real identities.

    Unmapped keys and null identities fail the job that writes the result. The fingerprint
    still covers the real source and ship-to codes, which do not leave this function.

    ``step`` carries out each lookup; with a ``session.Relay`` one lookup's rows lie in shuffle files at a time.
    """
    orders = clean_headers(orders, "spaces")
    require_columns(
        orders,
        ("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description", "product_category",
         "source_customer_code", "ship_to_customer_code", "customer_name"),
        "order history",
    )
    products = _checked_mapping(products, "full_sku_code", PRODUCT_CODES, "product mapping")
    customers = _checked_mapping(customers, "customer_hash_key", ("pseudo_customer_name",), "customer mapping")
    # Products come last: their long codes are moved by no lookup after them.
    rows = step(orders.drop(*UNREAD_PRODUCT, "created_by_user"))
    rows = step(rows, lambda part: _named_customers(part, customers))
    sku = F.col("full_sku_code")
    replaced = {
        "product_description": F.col("pseudo_product_description"),
        "product_category": F.col("pseudo_category"),
        "full_sku_code": mapped(F.col("pseudo_full_sku_code"), sku, "SKU"),
        "first_half_sku_code": F.col("pseudo_first_half_sku_code"),
        "unique_sku_code": F.col("pseudo_unique_sku_code"),
        "purchase_order_number": pseudonym(F.col("purchase_order_number"), F.col(SALT)),
        "company_code": pseudonym(F.col("company_code"), F.col(SALT)),
    }
    added = _flags(
        "product_description", "product_category", "customer_name", "sku_codes", "purchase_order_number",
        "company_code",
    )
    dropped = {"source_customer_code", "ship_to_customer_code", "created_by_user"}
    output = [name for name in orders.columns if name not in dropped]
    return step(rows, lambda part: _finish(part, products, salt, replaced, added, output, ORDER_HISTORY, at))


def pseudonymize_open_orders(
    orders: DataFrame, products: DataFrame, customers: DataFrame, routes: DataFrame, salt: str | DataFrame, at: datetime,
    step: Step = as_planned,
) -> DataFrame:
    """Open orders without real identities; the category is new information from the mapping. ``step`` as above."""
    orders = clean_headers(orders, "spaces")
    require_columns(
        orders,
        ("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description",
         "source_customer_code", "ship_to_customer_code", "customer_name", "delivery_route_name"),
        "open orders",
    )
    products = _checked_mapping(products, "full_sku_code", PRODUCT_CODES, "product mapping")
    customers = _checked_mapping(customers, "customer_hash_key", ("pseudo_customer_name",), "customer mapping")
    routes = _checked_mapping(routes, "delivery_route_name", ("pseudo_delivery_route_name",), "route mapping")
    rows = step(orders.drop(*UNREAD_PRODUCT))
    rows = step(rows, lambda part: _named_customers(part, customers))
    rows = step(rows, lambda part: _named_routes(part, routes))
    replaced = {
        "product_description": F.col("pseudo_product_description"),
        "full_sku_code": mapped(F.col("pseudo_full_sku_code"), F.col("full_sku_code"), "SKU"),
        "first_half_sku_code": F.col("pseudo_first_half_sku_code"),
        "unique_sku_code": F.col("pseudo_unique_sku_code"),
        "purchase_order_number": pseudonym(F.col("purchase_order_number"), F.col(SALT)),
        "company_code": pseudonym(F.col("company_code"), F.col(SALT)),
    }
    added = {
        **_flags("product_description", "customer_name", "sku_codes"),
        "product_category": F.col("pseudo_category"),
        "product_category_derived": F.lit(True),
        **_flags("delivery_route_name", "purchase_order_number", "company_code"),
    }
    dropped = {"source_customer_code", "ship_to_customer_code"}
    output = [name for name in orders.columns if name not in dropped]
    return step(rows, lambda part: _finish(part, products, salt, replaced, added, output, OPEN_ORDERS, at))


def pseudonymize_inventory(
    inventory: DataFrame, products: DataFrame, salt: str | DataFrame, at: datetime, step: Step = as_planned
) -> DataFrame:
    """Inventory without real SKUs; the raw number is restored to a SKU before the lookup. ``step`` as above."""
    inventory = clean_headers(inventory, "spaces")
    require_columns(
        inventory, ("raw_sku", "product_description", "snapshot_date", "warehouse_code"), "inventory"
    )
    products = _checked_mapping(products, "full_sku_code", PRODUCT_CODES, "product mapping")
    rows = step(inventory.drop("product_description", "product_category"))
    restored = lambda part: part.withColumn("full_sku_code", full_sku_from_number(F.col("raw_sku")))
    replaced = {
        "product_description": F.col("pseudo_product_description"),
        "warehouse_code": pseudonym(F.col("warehouse_code"), F.col(SALT)),
    }
    added = {
        "full_sku_code": mapped(F.col("pseudo_full_sku_code"), F.col("full_sku_code"), "SKU"),
        **_flags("product_description", "sku"),
        "product_category": F.col("pseudo_category"),
        "product_category_derived": F.lit(True),
        **_flags("warehouse_code"),
    }
    output = [name for name in inventory.columns if name != "raw_sku"]
    return step(rows, lambda part: _finish(restored(part), products, salt, replaced, added, output, INVENTORY, at))


def violations(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Privacy validator: what still looks real, and repeated fingerprints, from one pass over the batch.

    Counters are summed per fingerprint, then over all. Repeats (problem ``duplicate``, copies
    beyond the first) are reported and stop nothing.
    """
    require_columns(df, spec.validator_required, spec.name)
    problems = [
        (column, "not_pseudonymized", pattern_problem(F.col(column), rule, expected))
        for column, rule, expected in spec.validator_patterns
    ]
    problems.append(("row_hash", "missing", F.col("row_hash").isNull()))
    counted = df.groupBy(*short_fingerprint(F.col("row_hash").cast("string"))).agg(
        F.count("*").alias("rows"), *(F.count_if(bad).alias(f"bad_{k}") for k, (_, _, bad) in enumerate(problems))
    )
    totals = [(column, problem, F.sum(f"bad_{k}")) for k, (column, problem, _) in enumerate(problems)]
    totals.append(("row_hash", DUPLICATE, F.sum(F.col("rows") - 1)))
    counters = [
        F.struct(F.lit(column).alias("column_name"), F.lit(problem).alias("problem"), total.alias("row_count"))
        for column, problem, total in totals
    ]
    found = counted.agg(F.array(*counters).alias("found")).select(F.inline("found"))
    return found.where("row_count > 0").select(F.lit(spec.name).alias("dataset"), "*")


def unconfirmed_flags(df: DataFrame, flags: tuple[str, ...]) -> list[Column]:
    """Counters of rows whose removal flag is false or missing."""
    return [F.count_if(~F.col(flag).eqNullSafe(F.lit(True))).alias(flag.replace("original_", "").replace("_removed", "_not_confirmed")) for flag in flags]


def pseudonym_collisions(df: DataFrame, column: str, salt: str | DataFrame) -> DataFrame:
    """Replacements shared by several real values: short values collide by design."""
    values = salted(df.select(F.col(column).cast("string").alias("value")).distinct(), salt)
    return (
        values.select("value", pseudonym(F.col("value"), F.col(SALT)).alias("replacement"))
        .groupBy("replacement").agg(F.count("value").alias("real_values")).where("real_values > 1")
    )
