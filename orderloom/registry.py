"""Every query by name. Each reads whole tables of the given folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import codes, hashing
from orderloom.functions.dates import checked_day, checked_short_day
from orderloom.functions.text import null_if_token
from orderloom.operators import identities, privacy, publish, quality, reports, standardize
from orderloom.operators.guards import clean_headers, repeated_keys, unmapped_keys
from orderloom.operators.numbering import last_sequence
from orderloom.operators.repeats import line_sequence, repeated_rows
from orderloom.plans import jobs, staging
from orderloom.plans.inputs import DEMO_SALT, RUN_AT, STANDARDIZED, Inputs
from orderloom.plans.jobs import Workspace
from orderloom.plans.views import Catalog
from orderloom.session import held, materialize, scratch_path
from orderloom.sources import readers
from orderloom.sources import table_extracts as extracts
from orderloom.spec import (
    IDENTITY_COLUMNS,
    INVENTORY,
    INVENTORY_HEADERS,
    OPEN_ORDERS,
    OPEN_ORDERS_HEADERS,
    ORDER_HISTORY,
    ORDER_HISTORY_HEADERS,
    DatasetSpec,
)
from orderloom.streaming.intake import quarantined, run_file_intake

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
POSITION = extracts.POSITION


def named(name: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        return build

    return register


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    return named(build.__name__)(build)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- intake and sources -------------------------------------------------------------------


@query
def latest_batch(i: Inputs) -> DataFrame:
    return readers.latest_batch(i.history("batch_id", "order_number", "unique_sku_code", *POSITION), "batch_id")


@query
def source_row_numbers(i: Inputs) -> DataFrame:
    """Line items written as delimited files; the position found in each file plus the
    file's first line gives back the position the lines had before."""
    path = scratch_path(i.spark, "delimited")
    lines = extracts.table(i.spark, i.sf_dir, "lineitem").select(
        readers.parquet_row_number().alias("line"), "l_orderkey", "l_partkey"
    )
    lines.write.option("header", True).csv(path)
    placed = readers.number_csv_rows(
        readers.read_extract(i.spark, path).select("line", "l_orderkey", "l_partkey")
        .withColumn("file", F.col("_metadata.file_path"))
    )
    first = placed.groupBy(F.col("file").alias("f")).agg(F.min(F.col("line").cast("bigint")).alias("first"))
    return placed.join(first, F.col("file") == F.col("f")).select(
        F.col("line").cast("bigint").alias("line"),
        (F.col("first") + F.col("source_file_row_number") - 1).alias("found_line"),
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_partkey").cast("bigint").alias("l_partkey"),
    )


@query
def align_to_schema(i: Inputs) -> DataFrame:
    loaded = i.history("order_number", "company_code", "created_by_user", "ordered_quantity", *POSITION).toDF(
        "ORDER_NUMBER", "Company_Code", "created_by_user", "Ordered_Quantity", "SOURCE_FILENAME",
        "source_file_row_number",
    )
    target = T.StructType.fromDDL(
        "company_code string, order_number string, warehouse_code string, ordered_quantity bigint, "
        "source_filename string, source_file_row_number bigint"
    )
    return readers.align_to_schema(loaded, target)


@query
def null_tokens(i: Inputs) -> DataFrame:
    """Priorities as a careless export writes them, then read under the text format's rules."""
    exported = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("NULL"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(" null "))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit("  "))
        .otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
    )
    orders = extracts.table(i.spark, i.sf_dir, "orders").select("o_orderkey", exported.alias("exported"))
    return orders.select("o_orderkey", "exported", null_if_token(F.col("exported")).alias("value"))


@query
def new_files_only(i: Inputs) -> DataFrame:
    """Content digests of the history files; those of committed runs are left out."""
    files = readers.content_digest(
        i.raw_history().select("source_filename", "row_hash", "source_file_row_number"),
        ["source_filename"], F.col("row_hash"), F.col("source_file_row_number"),
    )
    files = materialize(files, "digests")
    committed = readers.run_id(F.col("source_filename")) < extracts.RUNS["R"]
    return readers.new_files_only(files, files.where(committed))


@query
def intake_refused(i: Inputs) -> DataFrame:
    """History files that the guard refuses: their content was committed before."""
    files = materialize(readers.content_digest(
        i.raw_history().select("source_filename", "row_hash", "source_file_row_number"),
        ["source_filename"], F.col("row_hash"), F.col("source_file_row_number"),
    ), "digests")
    committed = readers.run_id(F.col("source_filename")) < extracts.RUNS["R"]
    return readers.refused_files(files, files.where(committed))


@query
def snapshot_exists(i: Inputs) -> DataFrame:
    """Snapshot dates of arriving inventory files that the published stock already has."""
    arriving = i.inventory("source_filename").select(readers.snapshot_id(F.col("source_filename")).alias("snapshot_id"))
    return readers.known_snapshots(arriving, i.raw_inventory())


@query
def filename_ids(i: Inputs) -> DataFrame:
    names = i.history("source_filename").unionAll(i.inventory("source_filename"))
    return names.groupBy("source_filename").agg(F.count("*").alias("row_count")).select(
        "source_filename", "row_count",
        readers.run_id(F.col("source_filename")).alias("run_id"),
        readers.snapshot_id(F.col("source_filename")).alias("snapshot_id"),
    )


@query
def source_file_fingerprints(i: Inputs) -> DataFrame:
    """The digest of every open-order and inventory file, from its rows in their places."""
    names = ["source_filename", "row_hash", "source_file_row_number"]
    rows = i.raw_open_orders().select(*names).unionAll(i.raw_inventory().select(*names))
    return readers.content_digest(rows, names[:1], F.col("row_hash"), F.col("source_file_row_number"))


@query
def schema_discovery(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "delimited")
    columns = ("order_number", "full_sku_code", "order_date", "ordered_quantity", "order_amount", "ingested_at_datetime")
    i.history(*columns).select(*columns).write.option("header", True).csv(path)
    return readers.discover_schema(i.spark, path)


@query
def column_catalog(i: Inputs) -> DataFrame:
    return readers.catalog(staging.stg_order_history(i.raw_history()), count_filled=True)


def _raw_history(i: Inputs, extra: dict[str, Column] | None = None) -> DataFrame:
    return extracts.coded(i.history(*extracts.ORDER_HISTORY_COLUMNS), ORDER_HISTORY_HEADERS, extra)


@query
def batch_metadata(i: Inputs) -> DataFrame:
    rows = i.raw_history().select("row_hash", "source_file_row_number")
    digest = readers.content_digest(rows, [], F.col("row_hash"), F.col("source_file_row_number")).scalar()
    record = standardize.batch_metadata(
        _raw_history(i), "order_history", "20260715_181006_000001", F.lit("orders.csv"), digest, RUN_AT, 1.5
    )
    return record.withColumn("columns", F.array_join("columns", ","))


@query
def ingest_tagged(i: Inputs) -> DataFrame:
    messy = _raw_history(i).drop("batch_id", "ingested_at").withColumnsRenamed(
        {"comp_cd": " Comp Cd", "ord_no": "Ord/No", "sku_full": "SKU-Full "}
    )
    return standardize.tag_batch(messy, "20260715_181006_000001", RUN_AT)


@query
def ingest_snapshot(i: Inputs) -> DataFrame:
    raw = extracts.coded(i.inventory(*INVENTORY_HEADERS.values()), INVENTORY_HEADERS)
    return standardize.tag_snapshot(raw, " 07 ", "20260710")


@named("clean_headers")
def clean_header_names(i: Inputs) -> DataFrame:
    df = i.history("company_code", "order_number", "ordered_quantity").toDF(" Company Code", "ORDER/Number", "Ordered-Quantity ")
    return clean_headers(df)


@query
def schema_drift(i: Inputs) -> DataFrame:
    raw = _raw_history(i, {"ord_channel": F.when(F.col("ord_type").isNotNull(), F.lit("web")), "promo_cd": F.lit("x")})
    return standardize.drift_report(raw.drop("qty_short", "ord_amt"), ORDER_HISTORY)


# --- standardize --------------------------------------------------------------------------


@query
def standardize_order_history(i: Inputs) -> DataFrame:
    return standardize.standardize(_raw_history(i), ORDER_HISTORY, STANDARDIZED)


@query
def standardize_open_orders(i: Inputs) -> DataFrame:
    raw = extracts.coded(
        i.open_orders(*extracts.OPEN_ORDERS_COLUMNS), OPEN_ORDERS_HEADERS,
        {"sched_ship_dt_alt": F.lit("x"), "ord_val": F.lit("0"), "created_by": F.lit("u1")},
    )
    return standardize.standardize(raw, OPEN_ORDERS, STANDARDIZED)


@query
def standardize_inventory(i: Inputs) -> DataFrame:
    raw = extracts.coded(i.inventory(*extracts.INVENTORY_COLUMNS), INVENTORY_HEADERS)
    return standardize.standardize(raw, INVENTORY, STANDARDIZED)


# --- scalar functions ---------------------------------------------------------------------


@query
def customer_keys(i: Inputs) -> DataFrame:
    return identities.with_customer_key(i.history(*IDENTITY_COLUMNS, *POSITION))


@query
def row_hash(i: Inputs) -> DataFrame:
    rows = i.history()
    return rows.select(*POSITION, hashing.row_fingerprint(rows.schema, ORDER_HISTORY.fingerprint).alias("row_hash"))


@query
def salted_hash(i: Inputs) -> DataFrame:
    rows = privacy.salted(i.history("purchase_order_number", "order_type", *POSITION), DEMO_SALT)
    return rows.select(
        *POSITION,
        hashing.salted_hash(F.col("purchase_order_number"), F.col(privacy.SALT)).alias("purchase_order_hash"),
        hashing.salted_hash(F.col("order_type"), F.col(privacy.SALT)).alias("order_type_hash"),
    )


@query
def pseudonym(i: Inputs) -> DataFrame:
    rows = i.history("purchase_order_number", "order_type", "product_description", *POSITION)
    rows = privacy.salted(rows, DEMO_SALT)
    return rows.select(
        *POSITION,
        *(
            hashing.pseudonym(F.col(name), F.col(privacy.SALT)).alias(f"{name}_pseudonym")
            for name in ("purchase_order_number", "order_type", "product_description")
        ),
    )


@query
def pseudonym_collisions(i: Inputs) -> DataFrame:
    return privacy.pseudonym_collisions(i.history("source_customer_code"), "source_customer_code", DEMO_SALT)


@query
def reconstruct_sku(i: Inputs) -> DataFrame:
    full = codes.full_sku_from_number(F.col("raw_sku"))
    return i.inventory("raw_sku", *POSITION).select(
        *POSITION, "raw_sku", full.alias("full_sku_code"),
        codes.sku_component(full, 0).alias("first_half_sku_code"),
        codes.sku_component(full, 1).alias("unique_sku_code"),
    )


@query
def category_prefixes(i: Inputs) -> DataFrame:
    """Prefixes of the second run: kept where the first run assigned them, else allocated."""
    mapped = identities.map_products(i.stored_product_profile(), i.categories(), i.prior_products())
    return identities.category_prefixes(mapped)


@query
def shipped_date_parse(i: Inputs) -> DataFrame:
    names = ("order_date", "scheduled_ship_date", "shipped_date")
    distinct = i.history(*names).distinct()
    return distinct.select(
        F.col("order_date").alias("original_order_date"), checked_day(F.col("order_date")).alias("parsed_order_date"),
        F.col("scheduled_ship_date").alias("original_scheduled_date"),
        checked_day(F.col("scheduled_ship_date")).alias("parsed_scheduled_date"),
        F.col("shipped_date").alias("original_shipped_date"),
        checked_short_day(F.col("shipped_date")).alias("parsed_shipped_date"),
    )


@query
def ready_dates(i: Inputs) -> DataFrame:
    return publish.ready_dates(
        i.history("order_number", "order_date", "scheduled_ship_date", "shipped_date", "batch_id", *POSITION)
    )


# --- identities ---------------------------------------------------------------------------


@query
def customer_base(i: Inputs) -> DataFrame:
    return identities.customer_profile(i.history(*IDENTITY_COLUMNS))


@query
def new_customers(i: Inputs) -> DataFrame:
    return identities.new_customers(i.history(*IDENTITY_COLUMNS), i.prior_customers())


@query
def map_customers(i: Inputs) -> DataFrame:
    return i.customers()


@query
def product_base(i: Inputs) -> DataFrame:
    return i.product_profile()


@query
def category_profile(i: Inputs) -> DataFrame:
    return identities.category_profile(i.product_profile())


@query
def map_products(i: Inputs) -> DataFrame:
    """Second run: names assigned, SKU codes of the first run carried along."""
    return identities.map_products(i.stored_product_profile(), i.categories(), i.prior_products())


@query
def map_full_skus(i: Inputs) -> DataFrame:
    mapped = materialize(identities.map_products(i.stored_product_profile(), i.categories(), i.prior_products()), "products")
    return identities.map_full_skus(mapped).select("full_sku_code", "pseudo_category", "pseudo_full_sku_code")


@query
def map_sku_groups(i: Inputs) -> DataFrame:
    mapped = materialize(identities.map_products(i.stored_product_profile(), i.categories(), i.prior_products()), "products")
    return identities.map_sku_groups(mapped)


@query
def map_sku_bases(i: Inputs) -> DataFrame:
    mapped = materialize(identities.map_products(i.stored_product_profile(), i.categories(), i.prior_products()), "products")
    return identities.map_sku_bases(mapped)


@query
def map_skus(i: Inputs) -> DataFrame:
    return i.products()


@query
def distinct_routes(i: Inputs) -> DataFrame:
    return identities.route_profile(i.open_orders("delivery_route_name"))


@query
def map_routes(i: Inputs) -> DataFrame:
    return i.routes()


@query
def next_sequence(i: Inputs) -> DataFrame:
    """The next free number overall, and per category."""
    customers = last_sequence(i.customers(), "pseudo_customer_name").select(
        F.lit("customer").alias("scope"), (F.col("last_number") + 1).alias("next_number")
    )
    products = last_sequence(i.products(), "pseudo_full_sku_code", ["pseudo_category"], r"-(\d+)$", strict=True)
    return customers.unionByName(
        products.select(F.col("pseudo_category").alias("scope"), (F.col("last_number") + 1).alias("next_number"))
    )


# --- backfills ----------------------------------------------------------------------------

_OPEN_PRODUCT = ("full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description")


@query
def open_orders_only_products(i: Inputs) -> DataFrame:
    return identities.new_products(i.open_orders(*_OPEN_PRODUCT, *POSITION), i.prior_products())


@query
def open_orders_only_customers(i: Inputs) -> DataFrame:
    return identities.new_customers(i.open_orders(*IDENTITY_COLUMNS), i.prior_customers())


@query
def inventory_only_products(i: Inputs) -> DataFrame:
    return identities.inventory_products(i.inventory("raw_sku", "product_description", *POSITION), i.prior_products())


@query
def backfill_open_order_products(i: Inputs) -> DataFrame:
    existing = i.prior_products()
    fresh = materialize(identities.new_products(i.open_orders(*_OPEN_PRODUCT, *POSITION), existing), "fresh")
    return identities.backfill_products(fresh, existing)


@query
def backfill_inventory_products(i: Inputs) -> DataFrame:
    """Inventory after a backfill from open orders: the Unknown category exists by then, and its
    prefix and numbers continue."""
    existing = i.prior_products()
    opened = materialize(
        identities.new_products(i.open_orders(*_OPEN_PRODUCT, *POSITION), existing), "fresh"
    )
    existing = materialize(identities.backfill_products(opened, existing), "product-mapping")
    stocked = identities.inventory_products(i.inventory("raw_sku", "product_description", *POSITION), existing)
    return identities.backfill_products(materialize(stocked, "fresh"), existing)


@query
def backfill_open_order_customers(i: Inputs) -> DataFrame:
    profile = materialize(identities.customer_profile(i.open_orders(*IDENTITY_COLUMNS)), "profile")
    return identities.map_customers(profile, i.prior_customers())


# --- mapping checks -----------------------------------------------------------------------


@query
def mapping_violations(i: Inputs) -> DataFrame:
    """Both shared mappings with damage a manual edit could do."""
    name = F.col("pseudo_customer_name")
    customers = i.customers().withColumn(
        "pseudo_customer_name",
        F.when(F.col("ship_to_customer_code") == "0", F.lit(None))
        .when(F.col("ship_to_customer_code") == "1", F.col("customer_name"))
        .when(F.col("ship_to_customer_code") == "2", F.lit("Customer CUST-000001"))
        .otherwise(name),
    )
    category = F.col("pseudo_category")
    products = i.products().withColumns(
        {
            "pseudo_first_half_sku_code": F.when(category.startswith("Small"), F.lit("SKU-GRP-00001"))
            .otherwise(F.col("pseudo_first_half_sku_code")),
            "pseudo_product_description": F.when(category.startswith("Promo"), F.col("product_description"))
            .otherwise(F.col("pseudo_product_description")),
        }
    )
    return identities.violations(customers, products)


@query
def split_identities(i: Inputs) -> DataFrame:
    """Taking a group code's category for its pseudonym splits groups that span categories."""
    return identities.split_identities(i.history("first_half_sku_code", "product_category"), "first_half_sku_code", "product_category")


@query
def identity_collisions(i: Inputs) -> DataFrame:
    return identities.identity_collisions(i.history("first_half_sku_code", "product_category"), "first_half_sku_code", "product_category")


@query
def duplicate_mapping_keys(i: Inputs) -> DataFrame:
    """Uncleaned names make one customer code occur in several mapping rows."""
    uncleaned = i.history("source_customer_code", "customer_name").distinct()
    return repeated_keys(uncleaned, ["source_customer_code"])


@named("unmapped_keys")
def unmapped_customers(i: Inputs) -> DataFrame:
    keyed = identities.with_customer_key(i.history(*IDENTITY_COLUMNS))
    return unmapped_keys(keyed, i.prior_customers(), "customer_hash_key")


# --- pseudonymize -------------------------------------------------------------------------


@query
def lookup_products(i: Inputs) -> DataFrame:
    facts = i.history("full_sku_code", *POSITION)
    return privacy.lookup_products(facts, i.products())


@query
def lookup_customers(i: Inputs) -> DataFrame:
    facts = i.history(*IDENTITY_COLUMNS, *POSITION)
    return privacy.lookup_customers(facts, i.customers())


@query
def lookup_routes(i: Inputs) -> DataFrame:
    return privacy.lookup_routes(i.open_orders("delivery_route_name", *POSITION), i.routes())


@query
def pseudonymize_order_history(i: Inputs) -> DataFrame:
    return i.pseudonymized_history()


@query
def pseudonymize_open_orders(i: Inputs) -> DataFrame:
    return i.pseudonymized_open_orders()


@query
def pseudonymize_inventory(i: Inputs) -> DataFrame:
    return i.pseudonymized_inventory()


@query
def privacy_violations(i: Inputs) -> DataFrame:
    """The validators on batches nobody pseudonymized: everything must be found."""
    # Findings are stored dataset by dataset, so what one validator shuffles is gone when the next begins.
    found = materialize(privacy.violations(i.raw_history(), ORDER_HISTORY), "found")
    found = found.unionByName(materialize(privacy.violations(i.raw_open_orders(), OPEN_ORDERS), "found"))
    return found.unionByName(materialize(privacy.violations(i.raw_inventory(), INVENTORY), "found"))


@query
def privacy_violations_clean(i: Inputs) -> DataFrame:
    return privacy.violations(i.pseudonymized_history(), ORDER_HISTORY)


@query
def privacy_flags_unconfirmed(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    unlocated = F.lit(False)
    for name in ("source_filename", "source_file_row_number", "source_file_last_modified", "ingested_at"):
        unlocated = unlocated | F.col(name).isNull()
    return raw.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~F.col("batch_id").eqNullSafe(F.lit(extracts.BATCHES["O"]))).alias("unexpected_source_batch"),
        F.count_if(unlocated).alias("rows_missing_metadata"),
        *privacy.unconfirmed_flags(raw, ORDER_HISTORY.privacy_flags),
    )


# --- quality ------------------------------------------------------------------------------


@query
def null_counts(i: Inputs) -> DataFrame:
    return quality.null_counts(i.raw_history())


@query
def negative_values(i: Inputs) -> DataFrame:
    return quality.negative_values(i.history(*ORDER_HISTORY.gate_numeric), ORDER_HISTORY.gate_numeric)


@query
def duplicate_rows(i: Inputs) -> DataFrame:
    hashed = materialize(i.raw_history().select("row_hash", "order_number", "full_sku_code", *POSITION), "hashed")
    return repeated_rows(hashed, ["row_hash"])


@query
def quality_gate_order_history(i: Inputs) -> DataFrame:
    return quality.gate(i.pseudonymized_history(), ORDER_HISTORY)


@query
def quality_gate_open_orders(i: Inputs) -> DataFrame:
    return quality.gate(i.pseudonymized_open_orders(), OPEN_ORDERS)


@query
def quality_gate_inventory(i: Inputs) -> DataFrame:
    return quality.gate(i.pseudonymized_inventory(), INVENTORY)


def _gated(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """(landed batches, their statuses): one pseudonymized dataset and one that was not.

    Counts and reports are stored dataset by dataset, so that a batch is gone before the next is built.
    """
    good = i.pseudonymized_history()
    batches = _counted(good, ORDER_HISTORY)
    report = quality.stored_gate(good, ORDER_HISTORY)
    i.drop_copies()
    bad = i.raw_open_orders()
    batches = batches.unionByName(_counted(bad, OPEN_ORDERS))
    report = report.unionByName(quality.stored_gate(bad, OPEN_ORDERS))
    # One row of the older snapshot was lost on the way to the landing.
    short = F.when(F.col("batch_id") == extracts.SNAPSHOTS["F"], 1).otherwise(0)
    stocked = i.pseudonymized_inventory()
    counts = _counted(stocked, INVENTORY).withColumn("row_count", F.col("row_count") - short)
    report = report.unionByName(quality.stored_gate(stocked, INVENTORY))
    i.drop_copies()
    return batches.unionByName(counts), report


def _counted(batch: DataFrame, spec: DatasetSpec) -> DataFrame:
    counts = batch.groupBy(F.col(spec.batch_column).alias("batch_id")).agg(F.count("*").alias("row_count"))
    return materialize(counts.select(F.lit(spec.name).alias("dataset"), "batch_id", "row_count"), "counts")


def _saved(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """The same with the reports as the gate job leaves them: JSON documents, read back."""
    batches, report = _gated(i)
    path = scratch_path(i.spark, "reports")
    reports.save(reports.documents(materialize(report, "report")), path)
    return batches, reports.read(i.spark, path)


@query
def gate_status(i: Inputs) -> DataFrame:
    # Reports are stored one after another, so that a batch is gone before the next is built.
    report = quality.stored_gate(i.pseudonymized_history(), ORDER_HISTORY)
    i.drop_copies()
    report = report.unionByName(quality.stored_gate(i.raw_open_orders(), OPEN_ORDERS))
    report = report.unionByName(quality.stored_gate(i.pseudonymized_inventory(), INVENTORY))
    i.drop_copies()
    return quality.rollup(report)


@query
def authorized_batches(i: Inputs) -> DataFrame:
    return quality.authorized(*_saved(i))


@query
def publishable_batches(i: Inputs) -> DataFrame:
    return quality.publishable(*_saved(i))


@query
def duplicate_members(i: Inputs) -> DataFrame:
    """The gate's export of repeated rows, as written and read again."""
    path = scratch_path(i.spark, "duplicates")
    quality.duplicate_members(i.raw_history(), "batch_id").write.parquet(path)
    return i.spark.read.parquet(path).select("batch_id", "row_hash", "copies", *POSITION)


@query
def drift_findings(i: Inputs) -> DataFrame:
    """Header findings of two runs, kept next to their data and read back."""
    space = Workspace(i.spark, scratch_path(i.spark, "space"), DEMO_SALT)
    history = extracts.coded(i.history(), ORDER_HISTORY_HEADERS)
    opened = extracts.coded(i.open_orders(), OPEN_ORDERS_HEADERS, {"note": F.when(F.col("ord_no").isNotNull(), "x")})
    jobs.save_drift(space, history.drop("qty_short", "ord_amt", *POSITION), ORDER_HISTORY, extracts.RUNS["N"])
    jobs.save_drift(space, opened.drop(*POSITION), OPEN_ORDERS, extracts.RUNS["R"])
    return space.drift()


@query
def extract_positions_kept(i: Inputs) -> DataFrame:
    """A whole track from a delimited extract: each published row tells the extract's line it was.

    The delivery route carries a number that rises by one along each file of the extract, and the
    row's given place; ``moved`` is how far the published position is from that line.
    """
    place = F.concat_ws("|", F.monotonically_increasing_id(), *POSITION)
    rows = i.history(*extracts.ORDER_HISTORY_COLUMNS, *POSITION).withColumn("delivery_route", place).drop(*POSITION)
    extract = scratch_path(i.spark, "extract")
    extracts.coded(rows, ORDER_HISTORY_HEADERS).write.option("header", True).option("compression", "gzip").csv(extract)
    space = Workspace(i.spark, scratch_path(i.spark, "space"), DEMO_SALT)
    jobs.run_track(space, "order_history", extract, RUN_AT, i.categories(), extracts.RUNS["R"])
    published = space.published("order_history").read()
    part = lambda k: F.split_part("delivery_route", F.lit("|"), F.lit(k))
    placed = published.select(
        "order_number", F.col("source_filename").alias("file"), F.col("source_file_row_number").alias("found"),
        part(1).cast("bigint").alias("line"), part(2).alias("source_filename"), part(3).cast("bigint").alias("source_file_row_number"),
    )
    first = placed.groupBy(F.col("file").alias("f")).agg(F.min("line").alias("first"))
    moved = F.col("line") - F.col("first") + 1 - F.col("found")
    # One row per file of the extract, so the many rows need not move to it.
    return placed.join(F.broadcast(first), F.col("file") == F.col("f")).select("order_number", *POSITION, moved.alias("moved"))


# --- publication --------------------------------------------------------------------------


@query
def incoming_checks(i: Inputs) -> DataFrame:
    return publish.incoming_checks(i.raw_history(), ORDER_HISTORY, F.lit(extracts.BATCHES["O"]))


@query
def source_batch_diff(i: Inputs) -> DataFrame:
    """Staged rows include the correction file, the approved ones do not."""
    staged = i.history("batch_id", "source_filename")
    approved = staged.where(~F.col("source_filename").contains(extracts.CORRECTION_RUN))
    return publish.source_batch_diff(staged, approved)


_PUBLISHED = ("order_number", "unique_sku_code", "ordered_quantity", "order_date", "batch_id", *POSITION)


@query
def publish_partition_replace(i: Inputs) -> DataFrame:
    """Publish every file, one of them first incomplete, then replace that one whole."""
    raw = materialize(readers.align_to_schema(i.raw_history(), ORDER_HISTORY.published), "incoming")
    table = publish.CommittedTable(
        i.spark, scratch_path(i.spark, "published"), "order_history", ORDER_HISTORY.published
    )
    incomplete = (F.col("batch_id") == extracts.BATCHES["O"]) & F.col("source_filename").contains(extracts.RUNS["R"])
    table.replace_all(raw.where(incomplete), "source_filename", ORDER_HISTORY, at=RUN_AT)
    table.replace_all(raw, "source_filename", ORDER_HISTORY, expected_batches=raw, at=RUN_AT)
    return table.read().select(*_PUBLISHED).withColumn("ordered_quantity", F.col("ordered_quantity").cast("bigint"))


@query
def file_intake(i: Inputs) -> DataFrame:
    """Two streaming runs over landed files: the second finds only what came in between."""
    root = scratch_path(i.spark, "intake")
    landing = f"{root}/landing"
    schema = T.StructType.fromDDL(
        "order_number string, unique_sku_code string, batch_id string, source_filename string, "
        "source_file_row_number bigint"
    )
    rows = materialize(i.history(*schema.names), "arriving")
    table = publish.CommittedTable(i.spark, root, "order_history", schema)
    later = F.col("source_filename").contains(extracts.CORRECTION_RUN)
    for arriving in (rows.where(~later), rows.where(later)):
        arriving.write.mode("append").option("header", True).csv(landing)
        run_file_intake(i.spark, landing, "csv", schema, f"{root}/checkpoint", table)
    return table.read().groupBy("source_filename").agg(F.count("*").alias("row_count"))


@query
def file_intake_gated(i: Inputs) -> DataFrame:
    """Arriving files, each gated by itself: what each file's report says and how many rows went where."""
    root = scratch_path(i.spark, "intake")
    spec = replace(ORDER_HISTORY, gate_patterns=(), gate_required=("order_number", "row_hash"))
    names = ("order_number", "full_sku_code", "customer_name", "product_description", "product_category", "row_hash", "batch_id", *POSITION)
    rows = i.raw_history().select(*names)
    # The correction file lost some order numbers on its way.
    lost = F.col("source_filename").contains(extracts.CORRECTION_RUN) & F.col("order_number").endswith("2")
    rows = rows.withColumn("order_number", F.when(~lost, F.col("order_number")))
    with held(rows, "arriving") as arriving:
        arriving.write.option("header", True).option("compression", "gzip").csv(f"{root}/landing")
    table = publish.CommittedTable(i.spark, root, "order_history", rows.schema)
    run_file_intake(
        i.spark, f"{root}/landing", "csv", rows.schema, f"{root}/checkpoint", table, gate=spec, quarantine=f"{root}/held"
    )
    refused, verdicts = quarantined(i.spark, f"{root}/held")
    count = lambda df, name: df.groupBy(F.col("source_filename").alias("batch_id")).agg(F.count("*").alias(name))
    placed = verdicts.join(count(table.read(), "published_rows"), "batch_id", "left").join(count(refused, "held_rows"), "batch_id", "left")
    return placed.select(
        F.col("batch_id").alias("source_filename"), "overall_status", "row_count", F.array_join("failed_checks", ",").alias("failed_checks"),
        F.coalesce("published_rows", F.lit(0)).alias("published_rows"), F.coalesce("held_rows", F.lit(0)).alias("held_rows"),
    )


@query
def rows_per_source_file(i: Inputs) -> DataFrame:
    return staging.rows_per_source_file(i.raw_history())


@query
def batch_file_lineage(i: Inputs) -> DataFrame:
    return staging.batch_file_lineage(i.raw_history())


# --- staging views and data tests ---------------------------------------------------------


@query
def stg_order_history(i: Inputs) -> DataFrame:
    return staging.stg_order_history(i.raw_history())


@query
def stg_open_orders(i: Inputs) -> DataFrame:
    return staging.stg_open_orders(i.raw_open_orders())


def _catalog(i: Inputs, prefix: str, **sources: DataFrame) -> Catalog:
    """The declared views over the given sources, under names of this query's own."""
    return Catalog(i.spark, sources, f"{prefix}_")


@query
def staging_by_name(i: Inputs) -> DataFrame:
    """Both staging views joined by name in SQL, as any user of the catalog would."""
    catalog = _catalog(i, "by_name", raw_order_history=i.raw_history(), raw_open_orders=i.raw_open_orders())
    catalog.register()
    return i.spark.sql("""
        select h.product_category, count(*) as history_rows, sum(h.ordered_quantity) as ordered_quantity, max(o.open_rows) as open_rows
        from by_name_stg_order_history h left join
            (select product_category, count(*) as open_rows from by_name_stg_open_orders group by product_category) o
            on o.product_category = h.product_category
        group by h.product_category""").withColumn("ordered_quantity", F.col("ordered_quantity").cast("bigint"))


@query
def data_tests(i: Inputs) -> DataFrame:
    """Every declared data test on history as it is and on open orders with impossible dates."""
    return _catalog(i, "tested", raw_order_history=i.raw_history(), raw_open_orders=_impossible_dates(i)).run_tests()


def _full(quantity: str) -> Column:
    return F.col(quantity) == 50


@query
def not_null_tests(i: Inputs) -> DataFrame:
    history = staging.stg_order_history(i.raw_history())
    opened = staging.stg_open_orders(i.raw_open_orders())
    return staging.not_null_failures(opened, staging.NOT_NULL["stg_open_orders"], "stg_open_orders").unionByName(
        staging.not_null_failures(history, staging.NOT_NULL["stg_order_history"], "stg_order_history")
    )


@query
def not_null_tests_defect(i: Inputs) -> DataFrame:
    damaged = i.raw_open_orders().withColumn(
        "company_code", F.when(~_full("final_order_quantity"), F.col("company_code"))
    )
    opened = staging.stg_open_orders(damaged)
    return staging.not_null_failures(opened, staging.NOT_NULL["stg_open_orders"], "stg_open_orders")


@query
def order_history_quantities_preserved(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    return staging.quantities_changed(raw, staging.stg_order_history(raw))


@query
def order_history_quantities_preserved_defect(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    view = staging.stg_order_history(raw)
    damaged = view.withColumn(
        "quantity_short", F.when(_full("ordered_quantity"), F.lit(None)).otherwise(F.col("quantity_short"))
    )
    return staging.quantities_changed(raw, damaged)


@query
def open_orders_measures_preserved(i: Inputs) -> DataFrame:
    raw = i.raw_open_orders()
    return staging.measures_changed(raw, staging.stg_open_orders(raw))


@query
def open_orders_measures_preserved_defect(i: Inputs) -> DataFrame:
    raw = i.raw_open_orders()
    weight = F.col("estimated_order_weight")
    damaged = staging.stg_open_orders(raw).withColumn(
        "estimated_order_weight",
        F.when(_full("final_order_quantity"), (weight + 1).cast("decimal(18,4)")).otherwise(weight),
    )
    return staging.measures_changed(raw, damaged)


@query
def open_orders_dates_standardized(i: Inputs) -> DataFrame:
    raw = i.raw_open_orders()
    return staging.dates_not_standardized(raw, staging.stg_open_orders(raw))


def _impossible_dates(i: Inputs) -> DataFrame:
    return i.raw_open_orders().withColumn(
        "order_date", F.when(_full("final_order_quantity"), F.lit(20260230)).otherwise(F.col("order_date")).cast("bigint")
    )


@query
def open_orders_dates_standardized_defect(i: Inputs) -> DataFrame:
    raw = _impossible_dates(i)
    view = staging.stg_open_orders(raw).where(F.col("shipped_order_quantity") != 49)
    return staging.dates_not_standardized(raw, view)


@query
def order_history_row_count_preserved(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    return staging.row_count_difference(raw, staging.stg_order_history(raw))


@query
def order_history_row_count_preserved_defect(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    return staging.row_count_difference(raw, staging.stg_order_history(raw).where(~_full("ordered_quantity")))


@query
def open_orders_row_count_preserved(i: Inputs) -> DataFrame:
    raw = i.raw_open_orders()
    return staging.row_count_difference(raw, staging.stg_open_orders(raw))


@query
def open_orders_row_count_preserved_defect(i: Inputs) -> DataFrame:
    raw = i.raw_open_orders()
    return staging.row_count_difference(raw, staging.stg_open_orders(raw).where(~_full("final_order_quantity")))


@query
def open_orders_candidate_key_unique(i: Inputs) -> DataFrame:
    view = staging.stg_open_orders(i.raw_open_orders())
    return staging.repeated_combinations(view, staging.BUSINESS_KEY, "records_per_candidate_key")


@query
def order_history_source_position_unique(i: Inputs) -> DataFrame:
    view = staging.stg_order_history(i.raw_history())
    return staging.repeated_combinations(view, staging.SOURCE_POSITION, "records_at_position")


@query
def order_history_source_position_unique_defect(i: Inputs) -> DataFrame:
    view = staging.stg_order_history(i.raw_history())
    doubled = view.unionByName(view.where(_full("ordered_quantity")))
    return staging.repeated_combinations(doubled, staging.SOURCE_POSITION, "records_at_position")


@query
def open_orders_source_position_unique(i: Inputs) -> DataFrame:
    view = staging.stg_open_orders(i.raw_open_orders())
    return staging.repeated_combinations(view, staging.SOURCE_POSITION, "records_at_position")


@query
def open_orders_source_position_unique_defect(i: Inputs) -> DataFrame:
    view = staging.stg_open_orders(i.raw_open_orders())
    doubled = view.unionByName(view.where(_full("final_order_quantity")))
    return staging.repeated_combinations(doubled, staging.SOURCE_POSITION, "records_at_position")


# --- profiling ----------------------------------------------------------------------------


@query
def order_history_grain(i: Inputs) -> DataFrame:
    return staging.order_history_grain(i.raw_history())


@query
def order_history_repeated_rows(i: Inputs) -> DataFrame:
    return staging.order_history_repeated_rows(i.raw_history())


@query
def open_orders_grain(i: Inputs) -> DataFrame:
    return staging.open_orders_grain(i.raw_open_orders())


@query
def open_orders_repeated_rows(i: Inputs) -> DataFrame:
    return repeated_rows(i.raw_open_orders(), staging.BUSINESS_KEY)


@query
def open_orders_date_profile(i: Inputs) -> DataFrame:
    return staging.open_orders_date_profile(i.raw_open_orders())


@query
def open_orders_staging_summary(i: Inputs) -> DataFrame:
    raw = _impossible_dates(i)
    return staging.open_orders_staging_summary(raw, staging.stg_open_orders(raw))


@query
def invalid_open_order_dates(i: Inputs) -> DataFrame:
    return staging.invalid_open_order_dates(_impossible_dates(i))


@query
def order_history_date_checks(i: Inputs) -> DataFrame:
    """Dates with typical damage: a lost value, a slash date, a day that does not exist."""
    status = F.col("order_status")
    rows = i.history("order_date", "scheduled_ship_date", "shipped_date", "order_status", "ordered_quantity")
    full = F.col("ordered_quantity") == "50"
    damaged = rows.withColumns(
        {
            "order_date": F.when(~(full & (status == "F")), F.col("order_date")),
            "scheduled_ship_date": F.when(full & (status == "O"), F.lit("2026/02/28")).otherwise(F.col("scheduled_ship_date")),
            "shipped_date": F.when(full & (status == "P"), F.lit("23026")).otherwise(F.col("shipped_date")),
        }
    )
    return publish.order_history_date_checks(damaged)


@query
def candidate_key_counts(i: Inputs) -> DataFrame:
    counts = staging.candidate_key_counts(i.raw_history(), staging.BUSINESS_KEY, "order_history")
    counts = counts.unionByName(staging.candidate_key_counts(i.raw_open_orders(), staging.BUSINESS_KEY, "open_orders"))
    return counts.unionByName(staging.candidate_key_counts(i.raw_inventory(), staging.INVENTORY_KEY, "inventory"))


@query
def row_hash_counts(i: Inputs) -> DataFrame:
    return staging.row_hash_counts(i.raw_history())


@query
def source_identity(i: Inputs) -> DataFrame:
    damaged = i.raw_history().withColumn(
        "source_file_row_number", F.when(~_full("ordered_quantity"), F.col("source_file_row_number"))
    )
    return staging.source_identity(damaged)


@named("line_sequence")
def line_sequence_numbers(i: Inputs) -> DataFrame:
    rows = i.history(*staging.LINE_KEY, *POSITION)
    return line_sequence(materialize(rows, "lines"), staging.LINE_KEY, POSITION)


@query
def inventory_candidate_key_repeats(i: Inputs) -> DataFrame:
    return repeated_keys(i.raw_inventory(), staging.INVENTORY_KEY)


@query
def inventory_repeated_rows(i: Inputs) -> DataFrame:
    return repeated_rows(i.raw_inventory(), staging.INVENTORY_KEY)


@query
def repeated_row_hashes(i: Inputs) -> DataFrame:
    return repeated_keys(i.raw_history(), ["row_hash"])


@query
def repeated_order_po_sku(i: Inputs) -> DataFrame:
    return staging.top_repeats(i.raw_history(), staging.ORDER_PO_SKU, 20)


@query
def top_repeated_hashes(i: Inputs) -> DataFrame:
    return staging.top_repeats(i.raw_history(), ["row_hash"], 100)


@query
def raw_row_counts(i: Inputs) -> DataFrame:
    return staging.labelled_counts(
        "source_table", order_history=i.raw_history(), open_orders=i.raw_open_orders(), inventory=i.raw_inventory()
    )


@query
def raw_vs_staging_counts(i: Inputs) -> DataFrame:
    raw = i.raw_history()
    return staging.labelled_counts("layer", raw=raw, staging=staging.stg_order_history(raw))
