"""One SQL text per registered query that SQL can express."""

from __future__ import annotations

from oracles.tables import CLEAN, SALT, compose, open_day, pseudonym, trailing
from orderloom.spec import INVENTORY_HEADERS, OPEN_ORDERS_HEADERS, ORDER_HISTORY_HEADERS

POSITION = "source_filename, source_file_row_number"
BUSINESS = "company_code, order_number, unique_sku_code"
STOCK = "snapshot_date, warehouse_code, full_sku_code, pallet_number"
DAYS = ("order_date", "scheduled_ship_date", "customer_requested_date", "revised_delivery_date")
HISTORY = list(ORDER_HISTORY_HEADERS.values())
RAW_HEADERS = {raw: name for raw, name in ORDER_HISTORY_HEADERS.items() if raw not in ("batch_id", "ingested_at")}
OPEN = list(OPEN_ORDERS_HEADERS.values())
INVENTORY_RAW = INVENTORY_HEADERS
STANDARDIZED = "TIMESTAMP '2026-09-15 03:20:00' AS standardized_at"
CATALOG = (
    [(n, "string") for n in (
        "company_code", "order_number", "purchase_order_number", "customer_name", "full_sku_code",
        "first_half_sku_code", "unique_sku_code", "product_description", "product_category", "delivery_route",
        "order_type", "order_status")]
    + [(n, "date") for n in ("order_date", "scheduled_ship_date", "shipped_date")]
    + [(n, "bigint") for n in (
        "ordered_quantity", "secondary_order_quantity", "final_order_quantity", "shipped_order_quantity",
        "quantity_short")]
    + [("shipped_order_weight", "decimal(18,4)")]
    + [(f"original_{n}_removed", "boolean") for n in (
        "product_description", "product_category", "customer_name", "sku_codes", "purchase_order_number",
        "company_code")]
    + [("batch_id", "string"), ("row_hash", "string")]
    + [(n, "timestamp_ntz") for n in ("source_ingested_at", "standardized_at", "pseudonymized_at")]
    + [("source_filename", "string"), ("source_file_row_number", "bigint"),
       ("source_file_last_modified", "timestamp_ntz"), ("loaded_at", "timestamp_ntz")]
)
NEVER_NULL = {
    "product_description", "product_category", "original_product_description_removed",
    "original_product_category_removed", "original_customer_name_removed", "original_sku_codes_removed", "row_hash",
    "source_file_row_number",
}
PUBLISHED_HISTORY = [n for n, _ in CATALOG if n not in ("source_ingested_at", "loaded_at")] + [
    "order_amount", "ingested_at_datetime", "ingested_at"]


def repeated(source: str, keys: str, name: str = "row_count") -> str:
    return f"select {keys}, count(*) AS {name} from {source} group by {keys} having count(*) > 1"


def windowed(source: str, keys: str, name: str = "row_count", columns: str = "*") -> str:
    return (
        f"select * from (select {columns}, count(*) over (partition by {keys}) AS {name} from {source}) where {name} > 1"
    )


def labelled(column: str, **tables: str) -> str:
    return " union all ".join(f"select '{k}' AS {column}, count(*) AS row_count from {v}" for k, v in tables.items())


def changed(raw: str, view: str, columns: dict[str, str]) -> str:
    shown = ", ".join(f"r.{c} AS raw_{a}, s.{c} AS staging_{a}" for c, a in columns.items())
    only = ", ".join(columns)
    differs = " or ".join(f"r.{c} is distinct from s.{c}" for c in columns)
    return (
        f"select r.source_filename, r.source_file_row_number, {shown} from (select {POSITION}, {only} from {raw}) r join "
        f"(select {POSITION}, {only} from {view}) s "
        f"on r.source_filename = s.source_filename and r.source_file_row_number = s.source_file_row_number where {differs}"
    )


QUANTITIES = {
    "ordered_quantity": "ordered_quantity", "secondary_order_quantity": "secondary_quantity",
    "final_order_quantity": "final_quantity", "shipped_order_quantity": "shipped_quantity",
    "quantity_short": "quantity_short",
}
MEASURES = {n: n for n in (
    "final_order_quantity", "shipped_order_quantity", "estimated_order_weight", "shipped_order_weight")}


def day(column: str) -> str:
    return f"try_strptime({column}::VARCHAR, '%Y%m%d')::DATE"


def unexpected(column: str) -> str:
    return f"({column} is not null and {column} <> 0 and {day(column)} is null)"


def dates_differ(raw: str, view: str) -> str:
    wrong = " or ".join(
        f"{unexpected('r.' + d)} or s.{d} is distinct from {open_day('r.' + d)}" for d in DAYS
    )
    return f"""select coalesce(r.source_filename, s.source_filename) AS source_filename,
  coalesce(r.source_file_row_number, s.source_file_row_number) AS source_file_row_number
  from {raw} r full outer join {view} s
  on r.source_filename = s.source_filename and r.source_file_row_number = s.source_file_row_number
  where r.source_filename is null or s.source_filename is null or {wrong}"""


def counts_differ(raw: str, view: str) -> str:
    return (
        f"select * from (select (select count(*) from {raw}) AS raw_rows, (select count(*) from {view}) AS staging_rows) "
        "where raw_rows <> staging_rows"
    )


def not_null(**models: tuple[str, tuple[str, ...]]) -> str:
    parts = [
        f"select '{model}' AS model, '{c}' AS column_name, count_if({c} is null) AS null_rows from {source} having count_if({c} is null) > 0"
        for model, (source, columns) in models.items() for c in columns
    ]
    return " union all ".join(parts)


OPEN_NOT_NULL = ("company_code", "order_number", "unique_sku_code", "source_filename", "source_file_row_number")
SHORT_CHECK = """CASE WHEN regexp_full_match(shipped_date, '[0-9]{5,6}') THEN try_strptime(
  CASE WHEN lpad(shipped_date, 6, '0')[5:6] >= '70' THEN '19' ELSE '20' END || lpad(shipped_date, 6, '0')[5:6]
  || lpad(shipped_date, 6, '0')[1:4], '%Y%m%d')::DATE END"""


def day_check(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]{{8}}') THEN try_strptime({column}, '%Y%m%d')::DATE END"


# --- gates --------------------------------------------------------------------------------

GATES = {
    "order_history": dict(
        batch="batch_id", required=16,
        critical=("order_number", "full_sku_code", "customer_name", "product_description", "product_category", "row_hash"),
        numeric=("ordered_quantity", "final_order_quantity", "shipped_order_quantity", "shipped_order_weight", "order_amount"),
        patterns=(("customer_pseudonymization", "bad_customer_rows", "starts_with(customer_name, 'Customer CUST-')"),
                  ("product_pseudonymization", "bad_product_rows", "contains(product_description, ' Product ')")),
    ),
    "open_orders": dict(
        batch="batch_id", required=13,
        critical=("order_number", "full_sku_code", "customer_name", "product_description", "row_hash"),
        numeric=("final_order_quantity", "shipped_order_quantity", "estimated_order_weight", "shipped_order_weight", "order_amount"),
        patterns=(("customer_pseudonymization", "bad_customer_rows", "starts_with(customer_name, 'Customer CUST-')"),
                  ("product_pseudonymization", "bad_product_rows", "contains(product_description, ' Product ')")),
    ),
    "inventory": dict(
        batch="snapshot_date", required=8,
        critical=("full_sku_code", "product_description", "row_hash"),
        numeric=("reserved_quantity", "quantity_on_hand", "weight"),
        patterns=(("product_pseudonymization", "bad_product_rows", "contains(product_description, ' Product ')"),
                  ("sku_pseudonymization", "bad_sku_rows", "starts_with(full_sku_code, 'SKU-')")),
    ),
}


def gate(dataset: str, source: str) -> str:
    """Checks as rows: totals per batch first, then one branch per metric."""
    g = GATES[dataset]
    b = g["batch"]
    values = {"n": "count(*)"}
    values |= {f"null_{c}": f"count_if({c} is null)" for c in g["critical"]}
    values |= {f"bad_{check}": f"count_if(not coalesce({p}, false))" for check, _, p in g["patterns"]}
    values["no_hash"] = "count_if(row_hash is null)"
    values |= {f"neg_{c}": f"count_if(try_cast({c} as DOUBLE) < 0)" for c in g["numeric"]}
    totals = ", ".join(f"{v} AS {k}" for k, v in values.items())
    nulls = "CASE WHEN greatest({}) > 0 THEN 'failed' ELSE 'passed' END".format(", ".join(f"null_{c}" for c in g["critical"]))
    negatives = "CASE WHEN greatest({}) > 0 THEN 'warning' ELSE 'passed' END".format(", ".join(f"neg_{c}" for c in g["numeric"]))

    def level(value: str, bad: str) -> str:
        return f"CASE WHEN {value} > 0 THEN '{bad}' ELSE 'passed' END"

    rows = [("required_columns", "missing_columns", "0", "'passed'"),
            ("row_count", "row_count", "n", "CASE WHEN n > 0 THEN 'passed' ELSE 'failed' END")]
    rows += [("critical_nulls", c, f"null_{c}", nulls) for c in g["critical"]]
    rows += [(check, metric, f"bad_{check}", level(f"bad_{check}", "failed")) for check, metric, _ in g["patterns"]]
    rows += [("row_hash_completeness", "missing_row_hash", "no_hash", level("no_hash", "failed")),
             ("duplicate_row_hash", "duplicate_row_hash_count", "dup", level("dup", "warning"))]
    rows += [("negative_numeric_values", c, f"neg_{c}", negatives) for c in g["numeric"]]
    tag = f"t_{dataset}"
    branches = " union all ".join(
        f"select '{dataset}' AS dataset, batch AS batch_id, '{c}' AS check_name, {s} AS status, '{m}' AS metric, ({v})::BIGINT AS value from {tag}"
        for c, m, v, s in rows
    )
    return f"""select * from (with {tag} as materialized (select * from
  (select {b} AS batch, {totals} from {source} group by 1) a join
  (select batch, sum(k - 1)::BIGINT AS dup from (select {b} AS batch, row_hash, count(*) AS k from {source} group by 1, 2) group by 1) d
  using (batch)) {branches})"""


def rollup(report: str) -> str:
    def names(status: str) -> str:
        return f"coalesce(string_agg(distinct CASE WHEN status = '{status}' THEN check_name END, ',' order by CASE WHEN status = '{status}' THEN check_name END), '')"

    return f"""select dataset, batch_id, CASE WHEN bool_or(status = 'failed') THEN 'failed'
  WHEN bool_or(status = 'warning') THEN 'passed_with_warnings' ELSE 'passed' END AS overall_status,
  coalesce(max(CASE WHEN check_name = 'row_count' THEN value END), 0) AS row_count,
  {names('failed')} AS failed_checks, {names('warning')} AS warning_checks from ({report}) group by 1, 2"""


REPORTS = " union all ".join((gate("order_history", "pseudo_oh"), gate("open_orders", "raw_oo"), gate("inventory", "pseudo_inv")))
BATCHES = """select 'order_history' AS dataset, batch_id, count(*) AS row_count from pseudo_oh group by 2
  union all select 'open_orders', batch_id, count(*) from raw_oo group by 2
  union all select 'inventory', snapshot_date, count(*) - CASE WHEN snapshot_date = '20260709' THEN 1 ELSE 0 END from pseudo_inv group by snapshot_date"""
AUTHORIZED = f"""select b.dataset, b.batch_id, b.row_count, s.overall_status, s.row_count AS reported_rows from ({BATCHES}) b
  join ({rollup(REPORTS)}) s using (dataset, batch_id) where s.overall_status in ('passed', 'passed_with_warnings')"""

# --- mapping violations -------------------------------------------------------------------

DAMAGED_CUSTOMERS = """(select * replace (CASE ship_to_customer_code WHEN '0' THEN NULL WHEN '1' THEN customer_name
  WHEN '2' THEN 'Customer CUST-000001' ELSE pseudo_customer_name END AS pseudo_customer_name) from customers)"""
DAMAGED_PRODUCTS = """(select * replace (
  CASE WHEN starts_with(pseudo_category, 'Small') THEN 'SKU-GRP-00001' ELSE pseudo_first_half_sku_code END AS pseudo_first_half_sku_code,
  CASE WHEN starts_with(pseudo_category, 'Promo') THEN product_description ELSE pseudo_product_description END AS pseudo_product_description) from products)"""


def violations() -> str:
    parts = []
    for mapping, source, nulls, unique, pairs, (pattern_column, fits) in (
        ("customer_mapping", DAMAGED_CUSTOMERS, ("customer_hash_key", "pseudo_customer_name"), "customer_hash_key",
         (("customer_hash_key", "pseudo_customer_name"),),
         ("pseudo_customer_name", "starts_with(pseudo_customer_name, 'Customer CUST-')")),
        ("product_mapping", DAMAGED_PRODUCTS,
         ("full_sku_code", "first_half_sku_code", "unique_sku_code", "pseudo_full_sku_code",
          "pseudo_first_half_sku_code", "pseudo_unique_sku_code", "pseudo_category"), "full_sku_code",
         (("full_sku_code", "pseudo_full_sku_code"), ("first_half_sku_code", "pseudo_first_half_sku_code"),
          ("unique_sku_code", "pseudo_unique_sku_code")),
         ("pseudo_product_description", "contains(pseudo_product_description, ' Product ')")),
    ):
        def part(rule: str, column: str, count: str) -> None:
            parts.append(f"select '{mapping}' AS mapping, '{rule}' AS rule, '{column}' AS column_name, {count} AS offenders")

        for c in nulls:
            part("null_value", c, f"(select count_if({c} is null) from {source})")
        part("unlike_pseudonym", pattern_column, f"(select count_if(not coalesce({fits}, false)) from {source})")
        part("repeated_key", unique, f"(select count(*) from (select 1 from {source} group by {unique} having count(*) > 1))")
        for key, code in pairs:
            for rule, one, many in (("split_identity", key, code), ("identity_collision", code, key)):
                part(rule, one, f"(select count(*) from (select {one} from {source} where {one} is not null group by {one} having count(distinct {many}) > 1))")
    return f"select * from ({' union all '.join(parts)}) where offenders > 0"


def privacy(dataset: str, source: str, rules: tuple[tuple[str, str], ...]) -> str:
    parts = [
        f"select '{dataset}' AS dataset, '{c}' AS column_name, 'not_pseudonymized' AS problem, count_if(not coalesce({fits}, false)) AS row_count from {source}"
        for c, fits in rules
    ]
    parts.append(f"select '{dataset}' AS dataset, 'row_hash' AS column_name, 'missing' AS problem, count_if(row_hash is null) AS row_count from {source}")
    parts.append(f"select '{dataset}', 'row_hash', 'duplicate', count(*) - (select count(*) from (select distinct row_hash from {source})) from {source}")
    return f"select * from ({' union all '.join(parts)}) where row_count > 0"


CUSTOMER_RULE = ("customer_name", "starts_with(customer_name, 'Customer CUST-')")
PRODUCT_RULE = ("product_description", "contains(product_description, ' Product ')")
ROUTE_RULE = ("delivery_route_name", "starts_with(delivery_route_name, 'Route RT-')")
SKU_RULE = ("full_sku_code", "starts_with(full_sku_code, 'SKU-')")

DIGEST_WORDS = " || '|' || ".join(f"sum(('0x' || substr(placed, {start}, 8))::BIGINT)::VARCHAR" for start in (1, 9, 17, 25))


def file_digest(source: str) -> str:
    return (
        f"select source_filename, md5(count(*)::VARCHAR || '|' || {DIGEST_WORDS}) AS source_file_hash from "
        f"(select source_filename, md5(source_file_row_number::VARCHAR || '|' || row_hash) AS placed from {source}) group by 1"
    )


HISTORY_DIGEST = file_digest("raw_oh")

# What inference makes of the delimited columns.
DISCOVERED = {
    "order_number": "int", "full_sku_code": "string", "order_date": "int", "ordered_quantity": "int",
    "order_amount": "double", "ingested_at_datetime": "timestamp",
}

_SQL: dict[str, str] = {
    "latest_batch": f"select batch_id, order_number, unique_sku_code, {POSITION} from oh where batch_id = (select max(batch_id) from oh)",
    "source_row_numbers": "select line_row AS line, line_row AS found_line, l_orderkey, l_partkey from lines",
    "align_to_schema": f"select company_code, order_number, NULL::VARCHAR AS warehouse_code, ordered_quantity::BIGINT AS ordered_quantity, {POSITION} from oh",
    "null_tokens": """select o_orderkey, exported, CASE WHEN trim(exported) not in ('NULL', 'null', '') THEN trim(exported) END AS value
  from (select o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'NULL' WHEN '5-LOW' THEN ' null '
  WHEN '1-URGENT' THEN '  ' ELSE '  ' || o_orderpriority || ' ' END AS exported from orders)""",
    "new_files_only": f"select * from ({HISTORY_DIGEST}) where source_file_hash not in (select source_file_hash from ({HISTORY_DIGEST}) where regexp_extract(source_filename, '(\\d{{8}}_\\d{{6}})', 1) < '20260915_032626')",
    "intake_refused": f"select * from ({HISTORY_DIGEST}) where source_file_hash in (select source_file_hash from ({HISTORY_DIGEST}) where regexp_extract(source_filename, '(\\d{{8}}_\\d{{6}})', 1) < '20260915_032626')",
    "snapshot_exists": """select strftime(snapshot_date, '%Y%m%d') AS snapshot_id, count(*) AS published_rows from raw_inv
  where strftime(snapshot_date, '%Y%m%d') in (select regexp_extract(source_filename, '(\\d{8})', 1) from inv) group by 1""",
    "schema_discovery": " union all ".join(
        f"select {n}::BIGINT AS column_position, '{c}' AS column_name, '{t}' AS data_type, NULL::BIGINT AS numeric_precision, "
        f"NULL::BIGINT AS numeric_scale, 'YES' AS is_nullable where exists (select 1 from oh)"
        for n, (c, t) in enumerate(DISCOVERED.items(), start=1)
    ),
    "source_file_fingerprints": f"{file_digest('raw_oo')} union all {file_digest('raw_inv')}",
    "filename_ids": """select source_filename, count(*) AS row_count,
  nullif(regexp_extract(source_filename, '(\\d{8}_\\d{6})', 1), '') AS run_id,
  nullif(regexp_extract(source_filename, '(\\d{8})', 1), '') AS snapshot_id
  from (select source_filename from oh union all select source_filename from inv) group by 1""",
    "column_catalog": " union all ".join(
        f"""select {n}::BIGINT AS column_position, '{c}' AS column_name, '{t}' AS data_type,
  {'18::BIGINT' if 'decimal' in t else 'NULL::BIGINT'} AS numeric_precision, {'4::BIGINT' if 'decimal' in t else 'NULL::BIGINT'} AS numeric_scale,
  '{'NO' if c in NEVER_NULL else 'YES'}' AS is_nullable, count({c}) AS filled_rows from stg_oh"""
        for n, (c, t) in enumerate(CATALOG, start=1)
    ),
    "batch_metadata": f"""select 'order_history' AS dataset, '20260715_181006_000001' AS batch_id, 'orders.csv' AS source_file,
  (select md5(count(*)::VARCHAR || '|' || {DIGEST_WORDS}) from (select md5(source_file_row_number::VARCHAR || '|' || row_hash) AS placed from raw_oh)) AS source_file_hash, '2026-09-15T03:26:45' AS created_at, count(*) AS row_count, 27::BIGINT AS column_count,
  '{",".join([*RAW_HEADERS, "batch_id", "ingested_at"])}' AS columns, 1.5::DOUBLE AS duration_seconds from oh""",
    "ingest_tagged": "select " + ", ".join(f"{r} AS {c}" for c, r in RAW_HEADERS.items())
    + ", '20260715_181006_000001' AS batch_id, '2026-09-15T03:26:45' AS ingested_at from oh",
    "ingest_snapshot": "select " + ", ".join(f'{r} AS "{c}"' for c, r in INVENTORY_RAW.items())
    + ", '07' AS warehouse_code, '20260710' AS snapshot_date from inv",
    "clean_headers": "select company_code, order_number, ordered_quantity from oh",
    "schema_drift": """select * from (select 'unknown' AS finding, 'ord_channel' AS column_name, 'failed' AS status, count(order_type) AS filled_rows from oh
  union all select 'unknown', 'promo_cd', 'failed', count(*) from oh
  union all select 'missing', 'qty_short', 'warning', 0::BIGINT union all select 'missing', 'ord_amt', 'warning', 0::BIGINT)""",
    "standardize_order_history": f"select {', '.join(HISTORY)}, {STANDARDIZED} from oh",
    "standardize_open_orders": f"select {', '.join(OPEN)}, {STANDARDIZED} from oo",
    "standardize_inventory": f"select {', '.join(INVENTORY_RAW.values())}, warehouse_code, snapshot_date, {STANDARDIZED} from inv",
    "customer_keys": f"""select {', '.join(f"{CLEAN.format(c)} AS {c}" for c in HISTORY[1:4])}, customer_hash_key, {POSITION} from keyed_oh""",
    "row_hash": f"select {POSITION}, row_hash from raw_oh",
    "salted_hash": f"select {POSITION}, sha256(purchase_order_number || '{SALT}') AS purchase_order_hash, sha256(order_type || '{SALT}') AS order_type_hash from oh",
    "pseudonym": f"select {POSITION}, " + ", ".join(
        f"{pseudonym(c)} AS {c}_pseudonym" for c in ("purchase_order_number", "order_type", "product_description")) + " from oh",
    "pseudonym_collisions": f"""select replacement, count(*) AS real_values from (select distinct source_customer_code, {pseudonym('source_customer_code')} AS replacement from oh)
  group by 1 having count(*) > 1""",
    "reconstruct_sku": f"select {POSITION}, raw_sku, full_sku AS full_sku_code, split_part(full_sku, '-', 1) AS first_half_sku_code, split_part(full_sku, '-', 2) AS unique_sku_code from restored",
    "category_prefixes": "select pseudo_category, prefix from prefixes",
    "shipped_date_parse": f"""select distinct order_date AS original_order_date, {day_check('order_date')} AS parsed_order_date,
  scheduled_ship_date AS original_scheduled_date, {day_check('scheduled_ship_date')} AS parsed_scheduled_date,
  shipped_date AS original_shipped_date, {SHORT_CHECK} AS parsed_shipped_date from oh""",
    "ready_dates": f"select order_number, order_date, scheduled_ship_date, shipped_date, batch_id, {POSITION} from raw_oh",
    # identities
    "customer_base": "select * from customer_base",
    "new_customers": "select * from customer_base where customer_hash_key not in (select customer_hash_key from prior_customers)",
    "map_customers": "select * from customers",
    "product_base": "select * from product_base",
    "category_profile": "select product_category, count(*) AS product_count from product_base group by 1",
    "map_products": "select * from named",
    "map_full_skus": "select * from full_skus",
    "map_sku_groups": "select * from groups",
    "map_sku_bases": "select * from bases",
    "map_skus": "select * from products",
    "distinct_routes": "select * from route_base",
    "map_routes": "select * from routes",
    "next_sequence": f"""select 'customer' AS scope, max({trailing('pseudo_customer_name')}) + 1 AS next_number from customers
  union all select pseudo_category, max({trailing('pseudo_full_sku_code')}) + 1 from products group by 1""",
    # backfills
    "open_orders_only_products": "select * from opened",
    "open_orders_only_customers": "select * from customer_base where customer_hash_key not in (select customer_hash_key from prior_customers)",
    "inventory_only_products": "select * from stocked",
    "backfill_open_order_products": "select * from filled_opened",
    "backfill_inventory_products": "select * from filled_stocked_late",
    "backfill_open_order_customers": "select * from customers",
    # mapping checks
    "mapping_violations": violations(),
    "split_identities": "select 'first_half_sku_code' AS column_name, first_half_sku_code AS value, count(distinct product_category) AS partners from oh group by 2 having count(distinct product_category) > 1",
    "identity_collisions": "select 'product_category' AS column_name, product_category AS value, count(distinct first_half_sku_code) AS partners from oh group by 2 having count(distinct first_half_sku_code) > 1",
    "duplicate_mapping_keys": "select source_customer_code, count(*) AS row_count from (select distinct source_customer_code, customer_name from oh) group by 1 having count(*) > 1",
    "unmapped_keys": "select customer_hash_key from customer_base where customer_hash_key not in (select customer_hash_key from prior_customers)",
    # pseudonymize
    "lookup_products": f"""select f.full_sku_code, f.source_filename, f.source_file_row_number, p.pseudo_category,
  p.pseudo_product_description, p.pseudo_full_sku_code, p.pseudo_first_half_sku_code, p.pseudo_unique_sku_code
  from oh f left join products p on f.full_sku_code = p.full_sku_code""",
    "lookup_customers": f"""select {', '.join(f"{CLEAN.format('f.' + c)} AS {c}" for c in HISTORY[1:4])}, f.customer_hash_key,
  f.source_filename, f.source_file_row_number, c.pseudo_customer_name
  from keyed_oh f left join customers c on f.customer_hash_key = c.customer_hash_key""",
    "lookup_routes": """select f.delivery_route_name, f.source_filename, f.source_file_row_number, r.pseudo_delivery_route_name
  from oo f left join routes r on f.delivery_route_name = r.delivery_route_name""",
    "pseudonymize_order_history": "select * from pseudo_oh",
    "pseudonymize_open_orders": "select * from pseudo_oo",
    "pseudonymize_inventory": "select * from pseudo_inv",
    "privacy_violations": " union all ".join((
        privacy("order_history", "raw_oh", (CUSTOMER_RULE, PRODUCT_RULE)),
        privacy("open_orders", "raw_oo", (CUSTOMER_RULE, PRODUCT_RULE, ROUTE_RULE)),
        privacy("inventory", "raw_inv", (PRODUCT_RULE, SKU_RULE)))),
    "privacy_violations_clean": privacy("order_history", "pseudo_oh", (CUSTOMER_RULE, PRODUCT_RULE)),
    "privacy_flags_unconfirmed": """select count(*) AS total_rows,
  count_if(batch_id is distinct from '20260715_181006_000001') AS unexpected_source_batch,
  count_if(source_filename is null or source_file_row_number is null or source_file_last_modified is null or ingested_at is null) AS rows_missing_metadata, """
    + ", ".join(f"count_if(original_{c}_removed is distinct from true) AS {c}_not_confirmed" for c in (
        "company_code", "purchase_order_number", "customer_name", "sku_codes", "product_description", "product_category"))
    + " from raw_oh",
    # quality
    "null_counts": " union all ".join(f"select '{c}' AS column_name, count_if({c} is null) AS null_rows from raw_oh" for c in PUBLISHED_HISTORY),
    "negative_values": " union all ".join(
        f"select '{c}' AS column_name, count_if(try_cast({c} as DOUBLE) < 0) AS negative_rows from oh" for c in GATES["order_history"]["numeric"]),
    "duplicate_rows": windowed("raw_oh", "row_hash", columns=f"row_hash, order_number, full_sku_code, {POSITION}"),
    "quality_gate_order_history": gate("order_history", "pseudo_oh"),
    "quality_gate_open_orders": gate("open_orders", "pseudo_oo"),
    "quality_gate_inventory": gate("inventory", "pseudo_inv"),
    "gate_status": rollup(REPORTS),
    "authorized_batches": AUTHORIZED,
    "publishable_batches": f"select * from ({AUTHORIZED}) where reported_rows > 0 and reported_rows = row_count",
    # publication
    "incoming_checks": """select count(*) AS row_count, count_if(batch_id is distinct from '20260715_181006_000001') AS wrong_identity,
  count_if(source_filename is null or source_file_row_number is null or source_file_last_modified is null or ingested_at is null) AS missing_metadata from raw_oh""",
    "source_batch_diff": """select batch_id, count_if(not contains(source_filename, '20260922_041500')) AS expected_rows, count(*) AS staged_rows
  from oh group by 1 having count_if(not contains(source_filename, '20260922_041500')) <> count(*)""",
    "publish_partition_replace": f"select order_number, unique_sku_code, ordered_quantity, order_date, batch_id, {POSITION} from raw_oh",
    "duplicate_members": f"""select batch_id, row_hash, count(*) over (partition by batch_id, row_hash) AS copies, {POSITION} from raw_oh
  qualify copies > 1""",
    "drift_findings": """select 'order_history' AS dataset, '20260908_020000' AS run, 'missing' AS finding, unnest(['qty_short', 'ord_amt']) AS column_name,
  'warning' AS status, 0::BIGINT AS filled_rows
  union all select 'open_orders', '20260915_032626', 'unknown', 'note', 'failed', count(order_number) from oo""",
    "extract_positions_kept": f"select order_number, {POSITION}, 0::BIGINT AS moved from oh",
    "file_intake_gated": """select source_filename, CASE WHEN lost > 0 THEN 'failed' WHEN doubled > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS overall_status,
  row_count, CASE WHEN lost > 0 THEN 'critical_nulls' ELSE '' END AS failed_checks,
  CASE WHEN lost > 0 THEN 0 ELSE row_count END AS published_rows, CASE WHEN lost > 0 THEN row_count ELSE 0 END AS held_rows
  from (select source_filename, count(*) AS row_count, count(*) - count(distinct row_hash) AS doubled,
    count_if(contains(source_filename, '20260922_041500') and ends_with(order_number, '2')) AS lost from raw_oh group by 1)""",
    "file_intake": "select source_filename, count(*) AS row_count from oh group by 1",
    "rows_per_source_file": "select source_filename, count(*) AS row_count from raw_oh group by 1",
    "batch_file_lineage": """select batch_id, source_filename, count(*) AS row_count, min(shipped_date) AS earliest_shipped_date,
  max(shipped_date) AS latest_shipped_date, min(pseudonymized_at) AS earliest_privacy_processing,
  max(pseudonymized_at) AS latest_privacy_processing, max(ingested_at) AS latest_load_time from raw_oh group by 1, 2""",
    # staging
    "stg_order_history": "select * from stg_oh",
    "stg_open_orders": "select * from stg_oo",
    "not_null_tests": not_null(stg_open_orders=("stg_oo", OPEN_NOT_NULL), stg_order_history=("stg_oh", OPEN_NOT_NULL[3:])),
    "not_null_tests_defect": not_null(stg_open_orders=(
        "(select * replace (CASE WHEN final_order_quantity <> 50 THEN company_code END AS company_code) from stg_oo)", OPEN_NOT_NULL)),
    "order_history_quantities_preserved": changed("raw_oh", "stg_oh", QUANTITIES),
    "order_history_quantities_preserved_defect": changed(
        "raw_oh", "(select * replace (CASE WHEN ordered_quantity <> 50 THEN quantity_short END AS quantity_short) from stg_oh)", QUANTITIES),
    "open_orders_measures_preserved": changed("raw_oo", "stg_oo", MEASURES),
    "open_orders_measures_preserved_defect": changed(
        "raw_oo", "(select * replace ((CASE WHEN final_order_quantity = 50 THEN estimated_order_weight + 1 ELSE estimated_order_weight END)::DECIMAL(18,4) AS estimated_order_weight) from stg_oo)", MEASURES),
    "open_orders_dates_standardized": dates_differ("raw_oo", "stg_oo"),
    "open_orders_dates_standardized_defect": dates_differ("bad_oo", "(select * from stg_bad_oo where shipped_order_quantity <> 49)"),
    "order_history_row_count_preserved": counts_differ("raw_oh", "stg_oh"),
    "order_history_row_count_preserved_defect": counts_differ("raw_oh", "(select * from stg_oh where ordered_quantity <> 50)"),
    "open_orders_row_count_preserved": counts_differ("raw_oo", "stg_oo"),
    "open_orders_row_count_preserved_defect": counts_differ("raw_oo", "(select * from stg_oo where final_order_quantity <> 50)"),
    "open_orders_candidate_key_unique": repeated("stg_oo", BUSINESS, "records_per_candidate_key"),
    "order_history_source_position_unique": repeated("stg_oh", POSITION, "records_at_position"),
    "order_history_source_position_unique_defect": repeated(
        "(select * from stg_oh union all select * from stg_oh where ordered_quantity = 50)", POSITION, "records_at_position"),
    "open_orders_source_position_unique": repeated("stg_oo", POSITION, "records_at_position"),
    "open_orders_source_position_unique_defect": repeated(
        "(select * from stg_oo union all select * from stg_oo where final_order_quantity = 50)", POSITION, "records_at_position"),
    # profiling
    "order_history_grain": f"""select {BUSINESS}, count(*) AS rows_per_combination, count(distinct shipped_date) AS distinct_shipped_dates,
  min(shipped_date) AS earliest_shipped_date, max(shipped_date) AS latest_shipped_date from raw_oh group by {BUSINESS} having count(*) > 1""",
    "order_history_repeated_rows": windowed("raw_oh", BUSINESS, "candidate_key_row_count"),
    "open_orders_grain": f"""select count(*) AS total_rows, count_if(company_code is null or trim(company_code) = '') AS missing_company_codes,
  count_if(order_number is null) AS missing_order_numbers, count_if(unique_sku_code is null or trim(unique_sku_code) = '') AS missing_unique_sku_codes,
  (select count(*) from ({repeated('raw_oo', BUSINESS)})) AS duplicate_business_key_groups,
  count_if(source_filename is null or source_file_row_number is null) AS rows_missing_source_metadata,
  (select count(*) from ({repeated('raw_oo', POSITION)})) AS duplicate_source_positions from raw_oo""",
    "open_orders_repeated_rows": windowed("raw_oo", BUSINESS),
    "open_orders_date_profile": "select count(*) AS total_rows, " + ", ".join(
        [f"count_if({d} is null) AS missing_{d}s" for d in DAYS]
        + [f"count_if({d} is not null and {day(d)} is null) AS invalid_{d}s" for d in DAYS]
        + [f"min({day(d)}) AS earliest_{d}, max({day(d)}) AS latest_{d}" for d in DAYS]) + " from raw_oo",
    "open_orders_staging_summary": "select " + ", ".join(
        ["(select count(*) from bad_oo) AS raw_rows", "(select count(*) from stg_bad_oo) AS staging_rows"]
        + [f"(select count_if({d} = 0) from bad_oo) AS raw_zero_{d}s" for d in DAYS]
        + [f"(select count_if({unexpected(d)}) from bad_oo) AS unexpected_invalid_{n}" for d, n in zip(
            DAYS, ("order_dates", "scheduled_dates", "customer_requested_dates", "revised_delivery_dates"))]
        + [f"(select count_if({d} is null) from stg_bad_oo) AS staging_null_{d}s" for d in DAYS]),
    "invalid_open_order_dates": f"select {BUSINESS}, " + ", ".join(f"{d} AS raw_{d}, {day(d)} AS converted_{d}" for d in DAYS)
    + f", {POSITION} from bad_oo where " + " or ".join(f"({d} is not null and {day(d)} is null)" for d in DAYS),
    "order_history_date_checks": f"""select count(*) AS total_rows,
  count_if(order_date is null) AS missing_order_dates, count_if(scheduled_ship_date is null) AS missing_scheduled_dates,
  count_if(shipped_date is null) AS missing_shipped_dates,
  count_if(order_date is not null and {day_check('order_date')} is null) AS invalid_order_dates,
  count_if(scheduled_ship_date is not null and {day_check('scheduled_ship_date')} is null) AS invalid_scheduled_dates,
  count_if(shipped_date is not null and {SHORT_CHECK} is null) AS invalid_shipped_dates,
  min({SHORT_CHECK}) AS earliest_shipped_date, max({SHORT_CHECK}) AS latest_shipped_date
  from (select * replace (
    CASE WHEN NOT (ordered_quantity = '50' and order_status = 'F') THEN order_date END AS order_date,
    CASE WHEN ordered_quantity = '50' and order_status = 'O' THEN '2026/02/28' ELSE scheduled_ship_date END AS scheduled_ship_date,
    CASE WHEN ordered_quantity = '50' and order_status = 'P' THEN '23026' ELSE shipped_date END AS shipped_date) from oh)""",
    "candidate_key_counts": " union all ".join(
        f"select '{label}' AS source_table, (select count(*) from {source}) AS total_rows, (select count(*) from (select distinct {keys} from {source})) AS distinct_candidate_keys"
        for label, source, keys in (("order_history", "raw_oh", BUSINESS), ("open_orders", "raw_oo", BUSINESS), ("inventory", "raw_inv", STOCK))),
    "row_hash_counts": "select count(*) AS total_rows, count(distinct row_hash) AS distinct_row_hashes, count_if(row_hash is null) AS null_row_hashes from raw_oh",
    "source_identity": """select count(*) AS total_rows, count(*) - count(source_filename) AS missing_source_filenames,
  count(*) - count(position) AS missing_source_row_numbers,
  (select count(*) from (select distinct source_filename, source_file_row_number from raw_oh where ordered_quantity <> 50)) AS distinct_source_positions
  from (select *, CASE WHEN ordered_quantity <> 50 THEN source_file_row_number END AS position from raw_oh)""",
    "line_sequence": f"""select company_code, order_number, purchase_order_number, full_sku_code, {POSITION},
  row_number() over (partition by company_code, order_number, purchase_order_number, full_sku_code order by {POSITION}) AS line_sequence from oh""",
    "inventory_candidate_key_repeats": repeated("raw_inv", STOCK),
    "inventory_repeated_rows": windowed("raw_inv", STOCK),
    "repeated_row_hashes": repeated("raw_oh", "row_hash"),
    "repeated_order_po_sku": repeated("raw_oh", "order_number, purchase_order_number, full_sku_code")
    + " order by row_count desc, order_number, purchase_order_number, full_sku_code limit 20",
    "top_repeated_hashes": repeated("raw_oh", "row_hash") + " order by row_count desc, row_hash limit 100",
    "raw_row_counts": labelled("source_table", order_history="raw_oh", open_orders="raw_oo", inventory="raw_inv"),
    "raw_vs_staging_counts": labelled("layer", raw="raw_oh", staging="stg_oh"),
}

_SQL["staging_by_name"] = """select h.product_category, count(*) AS history_rows, sum(h.ordered_quantity)::BIGINT AS ordered_quantity, max(o.open_rows) AS open_rows
  from stg_oh h left join (select product_category, count(*) AS open_rows from stg_oo group by 1) o on o.product_category = h.product_category group by 1"""
_SQL["data_tests"] = " union all ".join(
    f"select '{test}' AS test, count(*) AS failing_rows from ({sql})" for test, sql in {
        "order_history_quantities_preserved": _SQL["order_history_quantities_preserved"],
        "order_history_row_count_preserved": _SQL["order_history_row_count_preserved"],
        "order_history_source_position_unique": _SQL["order_history_source_position_unique"],
        "open_orders_measures_preserved": changed("bad_oo", "stg_bad_oo", MEASURES),
        "open_orders_dates_standardized": dates_differ("bad_oo", "stg_bad_oo"),
        "open_orders_row_count_preserved": counts_differ("bad_oo", "stg_bad_oo"),
        "open_orders_candidate_key_unique": repeated("stg_bad_oo", BUSINESS),
        "open_orders_source_position_unique": repeated("stg_bad_oo", POSITION),
    }.items()
)

# Blocks that several branches of a query read; computed once.
_SHARED = (
    "lines", "oh", "oo", "inv", "raw_oh", "prior_products", "products", "customers", "prior_customers", "named",
    "prior_named", "prior_full", "prior_customer_codes", "customer_codes", "pseudo_oh", "pseudo_oo", "pseudo_inv",
    "filled_opened_half", "stocked_late", "opened", "opened_half", "product_base", "prior_product_base",
    "fresh_categorized", "fresh_named", "prefixes", "prior_prefixes", "full_skus", "groups", "bases",
    "prior_groups", "prior_bases", "prior_routes", "routes", "customer_base", "prior_customer_base",
)


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql, _SHARED) for name, sql in _SQL.items()}

