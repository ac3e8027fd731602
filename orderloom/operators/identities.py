"""Stable identities: profiles, mappings that only grow, and backfills from other datasets.

A mapping is append-only. Every function takes the committed mapping (or None on the first
run) and returns it with codes added for keys it lacked; assigned codes never change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import codes
from orderloom.functions.hashing import customer_key
from orderloom.functions.text import identity_text, strip
from orderloom.operators.guards import (
    identity_problem,
    or_fail,
    require_columns,
    require_unique,
)
from orderloom.operators.numbering import assign_codes, last_sequence, number_rows
from orderloom.session import materialize
from orderloom.spec import (
    CUSTOMER_MAPPING_SCHEMA,
    IDENTITY_COLUMNS,
    PRODUCT_COLUMNS,
    PRODUCT_MAPPING_SCHEMA,
    PSEUDO_SKU_COLUMNS,
    ROUTE_MAPPING_SCHEMA,
)

CRITICAL_PRODUCT_COLUMNS = ("full_sku_code", "product_description", "product_category")
FILE_ORDER = ("source_filename", "source_file_row_number")


# --- profiles -----------------------------------------------------------------------------


def with_customer_key(orders: DataFrame) -> DataFrame:
    """Normalize the three identity columns and add their md5 key; a null part fails the job."""
    parts = [F.col(name) for name in IDENTITY_COLUMNS]
    key = or_fail(
        customer_key(*parts), identity_problem(*parts), F.lit("Null customer identity field")
    )
    return orders.withColumns(
        {**{name: identity_text(F.col(name)) for name in IDENTITY_COLUMNS}, "customer_hash_key": key}
    )


def customer_profile(orders: DataFrame) -> DataFrame:
    """One row per customer identity. The key is a function of the three columns, so distinct
    rows and keep-first per key are the same, and partial aggregation absorbs hot customers."""
    require_columns(orders, IDENTITY_COLUMNS, "orders")
    raw = orders.select(*IDENTITY_COLUMNS).distinct()
    return with_customer_key(raw).select("customer_hash_key", *IDENTITY_COLUMNS).distinct()


def first_per_key(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Keep the row of each key that comes first in file order.

    The earliest row number of equal rows of a file is a hash aggregate, which leaves a row per
    distinct value and file; only those meet the ordered comparison, for which Spark sorts.
    """
    *files, number = order
    distinct = df.groupBy(key, *columns, *files).agg(F.min(number).alias(number))
    kept = F.min_by(F.struct(*columns), F.struct(*order))
    return distinct.groupBy(key).agg(kept.alias("kept")).select(key, "kept.*")


def product_profile(orders: DataFrame) -> DataFrame:
    """One row per SKU, the earliest in file order; a null SKU, text or category fails the job."""
    require_columns(orders, PRODUCT_COLUMNS, "orders")
    problem = identity_problem(*(F.col(name) for name in CRITICAL_PRODUCT_COLUMNS))
    sku = or_fail(strip(F.col("full_sku_code")), problem, F.lit("Null critical product field"))
    rest = [name for name in PRODUCT_COLUMNS if name != "full_sku_code"]
    first = first_per_key(orders.withColumn("full_sku_code", sku), "full_sku_code", rest)
    return first.select(*PRODUCT_COLUMNS)


def category_profile(products: DataFrame) -> DataFrame:
    return products.groupBy("product_category").agg(F.count("*").alias("product_count"))


def route_profile(orders: DataFrame) -> DataFrame:
    """Distinct route names; rows without one carry no route to map."""
    return (
        orders.where(F.col("delivery_route_name").isNotNull())
        .select("delivery_route_name").distinct()
        .select(strip(F.col("delivery_route_name")).alias("delivery_route_name")).distinct()
    )


# --- customers and routes -----------------------------------------------------------------


def map_customers(profile: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Number new customers after the greatest assigned number, in key order.

    With the profile of open orders this is the customer backfill. Pass a stored profile: the
    numbering samples its input before sorting it.
    """
    code = "pseudo_customer_name"
    keys = CUSTOMER_MAPPING_SCHEMA.names[:-1]
    if existing is not None:
        require_columns(existing, ["customer_hash_key", code], "customer mapping")
        existing = existing.withColumn("customer_hash_key", strip(F.col("customer_hash_key")))
    mapped = assign_codes(
        profile.select(*keys), existing, "customer_hash_key", code, codes.CUSTOMER_PREFIX, codes.NAME_WIDTH
    )
    return mapped.select(*CUSTOMER_MAPPING_SCHEMA.names)


def map_routes(profile: DataFrame, existing: DataFrame | None) -> DataFrame:
    code = "pseudo_delivery_route_name"
    if existing is not None:
        require_columns(existing, ROUTE_MAPPING_SCHEMA.names, "route mapping")
        existing = existing.withColumn("delivery_route_name", strip(F.col("delivery_route_name")))
    mapped = assign_codes(
        profile, existing, "delivery_route_name", code, codes.ROUTE_PREFIX, codes.NAME_WIDTH
    )
    return mapped.select(*ROUTE_MAPPING_SCHEMA.names)


# --- products -----------------------------------------------------------------------------


def clean_category_mapping(categories: DataFrame) -> DataFrame:
    require_columns(categories, ["product_category", "pseudo_category"], "category mapping")
    cleaned = categories.select(
        identity_text(F.col("product_category")).alias("product_category"),
        strip(F.col("pseudo_category")).alias("pseudo_category"),
    )
    return require_unique(cleaned, "product_category", "category mapping")


def categorize(profile: DataFrame, categories: DataFrame) -> DataFrame:
    """Attach the pseudo category; a category nobody mapped fails the job."""
    cleaned = profile.withColumns(
        {
            "full_sku_code": strip(F.col("full_sku_code")),
            "product_category": identity_text(F.col("product_category")),
            "product_description": strip(F.col("product_description")),
        }
    )
    joined = cleaned.join(clean_category_mapping(categories), "product_category", "left")
    message = F.concat(F.lit("Unmapped category: "), F.coalesce(F.col("product_category"), F.lit("<null>")))
    return joined.withColumn(
        "pseudo_category", or_fail(F.col("pseudo_category"), F.col("pseudo_category").isNull(), message)
    )


def map_products(profile: DataFrame, categories: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Name new products per pseudo category, continuing its numbers.

    All columns of existing rows are carried, SKU codes included, so that a full second run
    finds them and keeps them.
    """
    current = categorize(profile, categories)
    if existing is not None:
        require_columns(
            existing, ["full_sku_code", "pseudo_category", "pseudo_product_description"], "product mapping"
        )
        existing = existing.withColumn("full_sku_code", strip(F.col("full_sku_code")))
        current = current.join(existing.select("full_sku_code"), "full_sku_code", "left_anti")
    fresh = number_rows(current, ["product_description", "full_sku_code"], ["pseudo_category"], "_n")
    number = F.col("_n")
    if existing is not None:
        last = last_sequence(existing, "pseudo_product_description", ["pseudo_category"], r"-(\d+)$")
        fresh = fresh.join(last, "pseudo_category", "left")
        number = number + F.coalesce(F.col("last_number"), F.lit(0))
    label = F.concat(
        F.col("pseudo_category"), F.lit(codes.PRODUCT_MARK), codes.initials(F.col("pseudo_category")), F.lit("-")
    )
    added = fresh.select(
        *PRODUCT_COLUMNS,
        "pseudo_category",
        codes.numbered(label, number, codes.DESCRIPTION_WIDTH).alias("pseudo_product_description"),
        *(F.lit(None).cast("string").alias(name) for name in PSEUDO_SKU_COLUMNS),
    )
    if existing is None:
        return added
    return existing.select(*_present_or_null(existing)).unionByName(added)


def _present_or_null(mapping: DataFrame):
    return [
        F.col(name) if name in mapping.columns else F.lit(None).cast("string").alias(name)
        for name in PRODUCT_MAPPING_SCHEMA.names
    ]


# Numbers are laid out in pieces of so many, so no row holds a longer list.
NUMBER_PIECE = 4096


def category_prefixes(products: DataFrame) -> DataFrame:
    """One SKU prefix per pseudo category.

    A category with assigned codes keeps the prefix found in them; having several is an error.
    A new one takes its initials, or the initials with the smallest free number from 2, in
    category order.

    The waiting categories of one set of initials are ranked, the numbers left free there by
    assigned prefixes are ranked too, and equal ranks meet. Different initials want the same
    name only where some end in digits (``P`` with 22, ``P2`` with 2). Then all categories up to
    the first that loses a name are settled, as those before it cannot change any more, and the
    others are ranked again. Other data take one round.
    """
    found = products.groupBy("pseudo_category").agg(
        F.min(codes.sku_code_prefix("pseudo_full_sku_code")).alias("lowest"),
        F.max(codes.sku_code_prefix("pseudo_full_sku_code")).alias("highest"),
        F.count("pseudo_full_sku_code").alias("coded"),
    )
    several = F.col("lowest") != F.col("highest")
    unreadable = (F.col("coded") > 0) & F.col("lowest").isNull()
    message = F.concat(F.lit("Corrupt SKU prefixes in category: "), F.col("pseudo_category"))
    settled = or_fail(F.col("lowest"), F.coalesce(several, F.lit(False)) | unreadable, message)
    named = materialize(
        found.select("pseudo_category", settled.alias("prefix"), codes.initials("pseudo_category").alias("base")),
        "prefixes",
    )
    done = named.where(F.col("prefix").isNotNull()).select("pseudo_category", "prefix")
    waiting = named.where(F.col("prefix").isNull()).select("pseudo_category", "base")
    while True:
        claims = materialize(_claimed_prefixes(waiting, done), "prefix-claims")
        lost = _lost_claims(claims)
        if lost.isEmpty():
            return done.unionByName(claims.select(*done.columns))
        first = lost.groupBy("stem").agg(F.min("pseudo_category").alias("first"))
        placed = claims.withColumn("stem", _stem("base")).join(first, "stem", "left")
        later = F.coalesce(F.col("pseudo_category") >= F.col("first"), F.lit(False))
        done = done.unionByName(placed.where(~later).select(*done.columns))
        waiting = placed.where(later).select(*waiting.columns)


def _stem(name: str) -> Column:
    return F.regexp_replace(name, r"\d+$", "")


def _claimed_prefixes(waiting: DataFrame, done: DataFrame) -> DataFrame:
    """``waiting`` with the prefix each would get if only assigned ones, and its own kind, stood in its way."""
    wanted = waiting.where(F.col("base").isNotNull()).groupBy("base").agg(F.count("*").alias("wanted"))
    # An assigned prefix is number 1 of itself, and a higher number of every shorter start whose rest is a number.
    digits = F.length("prefix") - F.length(_stem("prefix"))
    cuts = done.select("prefix", F.explode(F.sequence(F.lit(0), digits)).alias("cut"))
    number = F.expr("try_cast(right(prefix, cut) as bigint)")
    taken = cuts.select(
        F.expr("left(prefix, length(prefix) - cut)").alias("base"),
        F.when(F.col("cut") == 0, F.lit(1).cast("bigint"))
        .when(~F.expr("right(prefix, cut)").startswith("0") & (number > 1), number).alias("number"),
    ).where("number is not null").join(wanted.select("base"), "base", "left_semi")
    held = taken.groupBy("base").agg(F.count("*").alias("held"))
    last = F.col("wanted") + F.coalesce("held", F.lit(0))
    pieces = wanted.join(held, "base", "left").select(
        "base", last.alias("last"), F.explode(F.sequence(F.lit(1).cast("bigint"), last, F.lit(NUMBER_PIECE).cast("bigint"))).alias("from")
    )
    until = F.least(F.col("last"), F.col("from") + (NUMBER_PIECE - 1))
    numbers = pieces.select("base", F.explode(F.sequence("from", until)).alias("number"))
    free = number_rows(numbers.join(taken, ["base", "number"], "left_anti"), ["number"], ["base"], "rank")
    ranked = number_rows(waiting, ["pseudo_category"], ["base"], "rank")
    name = F.when(F.col("number") == 1, F.col("base")).otherwise(F.concat("base", F.col("number").cast("string")))
    return ranked.join(free, ["base", "rank"], "left").select("pseudo_category", "base", name.alias("prefix"))


def _lost_claims(claims: DataFrame) -> DataFrame:
    """Claims to a prefix that an earlier category of other initials claims as well."""
    winners = claims.groupBy("prefix").agg(F.min("pseudo_category").alias("winner"), F.count("*").alias("n"))
    lost = claims.join(winners.where("n > 1"), "prefix").where("pseudo_category > winner")
    return lost.select("pseudo_category", _stem("base").alias("stem"))


def map_full_skus(products: DataFrame) -> DataFrame:
    """Code the SKUs that have none, per category, continuing the category's numbers."""
    if "pseudo_full_sku_code" not in products.columns:
        products = products.withColumn("pseudo_full_sku_code", F.lit(None).cast("string"))
    code = F.col("pseudo_full_sku_code")
    rest = [name for name in products.columns if name != "pseudo_full_sku_code"]
    coded = products.where(code.isNotNull())
    fresh = number_rows(
        products.where(code.isNull()).select(*rest),
        ["pseudo_product_description", "full_sku_code"], ["pseudo_category"], "_n",
    )
    last = last_sequence(coded, "pseudo_full_sku_code", ["pseudo_category"], r"-(\d+)$", strict=True)
    numbers = fresh.join(category_prefixes(products), "pseudo_category", "left").join(last, "pseudo_category", "left")
    prefix = F.concat(F.lit(codes.SKU_PREFIX), F.col("prefix"), F.lit("-"))
    number = F.col("_n") + F.coalesce(F.col("last_number"), F.lit(0))
    added = numbers.select(*rest, codes.numbered(prefix, number, codes.SKU_WIDTH).alias("pseudo_full_sku_code"))
    return coded.unionByName(added)


def map_component(products: DataFrame, key: str, code: str, prefix: str) -> DataFrame:
    """``key -> code`` for one SKU component; rows sharing a component share its code."""
    pairs = products.groupBy(key).agg(F.min(code).alias(code))
    existing = pairs.where(F.col(code).isNotNull())
    return assign_codes(pairs.select(key), existing, key, code, prefix, codes.PART_CODE_WIDTH, strict=True)


def map_sku_groups(products: DataFrame) -> DataFrame:
    return map_component(products, "first_half_sku_code", "pseudo_first_half_sku_code", codes.GROUP_PREFIX)


def map_sku_bases(products: DataFrame) -> DataFrame:
    return map_component(products, "unique_sku_code", "pseudo_unique_sku_code", codes.BASE_PREFIX)


def map_skus(products: DataFrame) -> DataFrame:
    """All three pseudo SKU columns for a product mapping."""
    products = products.select(*_present_or_null(products))
    full = map_full_skus(products)
    groups = map_sku_groups(products)
    bases = map_sku_bases(products)
    return (
        full.drop("pseudo_first_half_sku_code", "pseudo_unique_sku_code")
        .join(groups, "first_half_sku_code", "left")
        .join(bases, "unique_sku_code", "left")
        .select(*PRODUCT_MAPPING_SCHEMA.names)
    )


def build_product_mapping(profile: DataFrame, categories: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Profile to finished product mapping, written once between the two numbering steps."""
    return map_skus(materialize(map_products(profile, categories, existing), "products"))


# --- backfills ----------------------------------------------------------------------------


def new_products(rows: DataFrame, existing: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Products the mapping lacks, first occurrence in file order."""
    cleaned = rows.withColumn("full_sku_code", strip(F.col("full_sku_code")))
    unknown = cleaned.join(existing.select("full_sku_code"), "full_sku_code", "left_anti")
    columns = [c for c in ("first_half_sku_code", "unique_sku_code", "product_description") if c in rows.columns]
    return first_per_key(unknown, "full_sku_code", columns, order)


def inventory_products(inventory: DataFrame, existing: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """The same for inventory: the SKU is restored from its number and split at the dash."""
    restored = inventory.withColumn("full_sku_code", codes.full_sku_from_number(F.col("raw_sku")))
    fresh = new_products(restored.select("full_sku_code", "product_description", *order), existing, order)
    return fresh.select(
        "full_sku_code",
        codes.sku_component(F.col("full_sku_code"), 0).alias("first_half_sku_code"),
        codes.sku_component(F.col("full_sku_code"), 1).alias("unique_sku_code"),
        "product_description",
    )


def unknown_prefix(existing: DataFrame) -> DataFrame:
    """One row: the prefix of the Unknown category, established or the first free one."""
    prefix = codes.sku_code_prefix(F.col("pseudo_full_sku_code"))
    unknown = F.col("pseudo_category") == codes.UNKNOWN_CATEGORY
    facts = existing.agg(
        F.count_if(unknown).alias("members"),
        F.min(F.when(unknown, prefix)).alias("lowest"),
        F.max(F.when(unknown, prefix)).alias("highest"),
        # As many values as there are categories.
        F.collect_set(prefix).alias("used"),
    )
    corrupt = (F.col("members") > 0) & (F.col("lowest").isNull() | (F.col("lowest") != F.col("highest")))
    base = F.lit(codes.UNKNOWN_PREFIX)
    names = F.transform(
        F.sequence(F.lit(1), F.size("used") + 1),
        lambda k: F.when(k == 1, base).otherwise(F.concat(base, k.cast("string"))),
    )
    free = F.get(F.array_except(names, "used"), F.lit(0))
    chosen = F.when(F.col("members") > 0, F.col("lowest")).otherwise(free)
    return facts.select(
        or_fail(chosen, corrupt, F.lit("Unknown category has no single SKU prefix")).alias("prefix")
    )


def backfill_products(fresh: DataFrame, existing: DataFrame) -> DataFrame:
    """Append products seen only outside the order history, as the Unknown category."""
    existing = existing.select(*PRODUCT_MAPPING_SCHEMA.names)
    unknown = existing.where(F.col("pseudo_category") == codes.UNKNOWN_CATEGORY)
    prefix = unknown_prefix(existing).scalar()
    last_description = last_sequence(unknown, "pseudo_product_description", pattern=r"-(\d+)$").scalar()
    same_prefix = existing.where(codes.sku_code_prefix(F.col("pseudo_full_sku_code")) == prefix)
    last_sku = last_sequence(same_prefix, "pseudo_full_sku_code").scalar()

    numbers = number_rows(fresh, ["full_sku_code"], name="_n")
    description = F.lit(f"{codes.UNKNOWN_CATEGORY}{codes.PRODUCT_MARK}{codes.UNKNOWN_PREFIX}-")
    sku = F.concat(F.lit(codes.SKU_PREFIX), prefix, F.lit("-"))
    columns = ("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description")
    added = numbers.select(
        *columns,
        F.lit(codes.UNKNOWN_SOURCE_CATEGORY).alias("product_category"),
        F.lit(codes.UNKNOWN_CATEGORY).alias("pseudo_category"),
        codes.numbered(description, F.col("_n") + last_description, codes.DESCRIPTION_WIDTH)
        .alias("pseudo_product_description"),
        codes.numbered(sku, F.col("_n") + last_sku, codes.SKU_WIDTH).alias("pseudo_full_sku_code"),
    )
    for key, code, label in (
        ("first_half_sku_code", "pseudo_first_half_sku_code", codes.GROUP_PREFIX),
        ("unique_sku_code", "pseudo_unique_sku_code", codes.BASE_PREFIX),
    ):
        known = existing.where(F.col(code).isNotNull()).groupBy(key).agg(F.min(code).alias(code))
        wanted = fresh.select(key).distinct()
        added = added.join(assign_codes(wanted, known, key, code, label, codes.PART_CODE_WIDTH), key, "left")
    return existing.unionByName(added.select(*PRODUCT_MAPPING_SCHEMA.names))


def new_customers(orders: DataFrame, existing: DataFrame) -> DataFrame:
    return customer_profile(orders).join(existing.select("customer_hash_key"), "customer_hash_key", "left_anti")


# --- mapping checks -----------------------------------------------------------------------


def split_identities(mapping: DataFrame, key: str, code: str) -> DataFrame:
    """Keys with more than one code."""
    return _more_than_one(mapping, key, code)


def identity_collisions(mapping: DataFrame, key: str, code: str) -> DataFrame:
    """Codes with more than one key."""
    return _more_than_one(mapping, code, key)


def _more_than_one(mapping: DataFrame, one: str, many: str) -> DataFrame:
    return (
        mapping.where(F.col(one).isNotNull())
        .groupBy(F.col(one).alias("value"))
        .agg(F.count_distinct(many).alias("partners"))
        .where("partners > 1")
        .select(F.lit(one).alias("column_name"), "value", "partners")
    )


def violations(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every broken rule of the two shared mappings with the number of offenders.

    Every row states what each rule has to know of it as (rule, value, partner). One aggregate by
    value tells whether a rule is broken there, a second one counts: two exchanges for all rules
    of both mappings, each after partial sums, so a value that many rows share is a row per task.
    """
    require_columns(customers, CUSTOMER_MAPPING_SCHEMA.names, "customer mapping")
    require_columns(products, [n for n in PRODUCT_MAPPING_SCHEMA.names if n not in ("product_description", "product_category")], "product mapping")
    unlike = lambda name, fits: (name, ~F.coalesce(fits, F.lit(False)))
    stated = _statements(
        customers, "customer_mapping", ("customer_hash_key", "pseudo_customer_name"), "customer_hash_key",
        (("customer_hash_key", "pseudo_customer_name"),),
        unlike("pseudo_customer_name", F.col("pseudo_customer_name").startswith(codes.CUSTOMER_PREFIX)),
    ).unionByName(_statements(
        products, "product_mapping",
        ("full_sku_code", "first_half_sku_code", "unique_sku_code", *PSEUDO_SKU_COLUMNS, "pseudo_category"), "full_sku_code",
        (("full_sku_code", "pseudo_full_sku_code"), ("first_half_sku_code", "pseudo_first_half_sku_code"),
         ("unique_sku_code", "pseudo_unique_sku_code")),
        unlike("pseudo_product_description", F.col("pseudo_product_description").contains(codes.PRODUCT_MARK)),
    ))
    rule = ("mapping", "rule", "column_name")
    values = stated.groupBy(*rule, "value").agg(F.count("*").alias("rows"), F.min("partner").alias("low"), F.max("partner").alias("high"))
    offenders = (
        F.when(F.col("rule").isin("null_value", "unlike_pseudonym"), F.col("rows"))
        .when(F.col("rule") == "repeated_key", (F.col("rows") > 1).cast("bigint"))
        # More than one partner: the smallest is not the greatest. Null partners do not count.
        .otherwise((F.coalesce(F.col("low") != F.col("high"), F.lit(False)) & F.col("value").isNotNull()).cast("bigint"))
    )
    return values.groupBy(*rule).agg(F.sum(offenders).alias("offenders")).where("offenders > 0")


def _statements(
    mapping: DataFrame, label: str, no_nulls: Sequence[str], unique: str, pairs: Sequence[tuple[str, str]],
    unlike: tuple[str, Column],
) -> DataFrame:
    """``mapping, rule, column_name, value, partner``: per row what the rules on values and pairs need, and its own faults."""

    def statement(rule: str, column: str, value: Column, partner: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), value.cast("string").alias("value"), partner.cast("string").alias("partner")
        )

    none = F.lit(None)
    faults = [F.when(F.col(name).isNull(), statement("null_value", name, none, none)) for name in no_nulls]
    faults.append(F.when(unlike[1], statement("unlike_pseudonym", unlike[0], none, none)))
    known = [statement("repeated_key", unique, F.col(unique), none)]
    for key, code in pairs:
        known.append(statement("split_identity", key, F.col(key), F.col(code)))
        known.append(statement("identity_collision", code, F.col(code), F.col(key)))
    said = F.filter(F.array(*faults, *known), lambda one: one.isNotNull())
    return mapping.select(F.lit(label).alias("mapping"), F.inline(said))
