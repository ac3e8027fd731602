"""Named SQL building blocks over the given tables, and a composer that pulls in what a query uses."""

from __future__ import annotations

import re

from orderloom.spec import INVENTORY_FINGERPRINT, OPEN_ORDERS_FINGERPRINT, ORDER_HISTORY_FINGERPRINT

SALT = "demonstration-salt"
HISTORY_FINGERPRINT = list(ORDER_HISTORY_FINGERPRINT)
OPEN_FINGERPRINT = list(OPEN_ORDERS_FINGERPRINT)


def md5_of(columns: list[str], **instead: str) -> str:
    parts = (f"coalesce({instead.get(c, c)}, '\\N')" for c in columns)
    return "md5(" + " || '|' || ".join(parts) + ")"


def pad(text: str, width: int) -> str:
    return f"lpad({text}, greatest({width}, length({text}))::INTEGER, '0')"


def pseudonym(value: str) -> str:
    """Character i comes from byte i of the digests of value, salt and round."""
    digests = (
        f"array_to_string([sha256({value} || '{SALT}' || r::VARCHAR) "
        f"for r in range(0, (greatest(length({value}), 1) - 1) // 32 + 1)], '')"
    )
    hexes = "strpos('0123456789abcdef', substr({d}, {p}, 1)) - 1"
    byte = f"(({hexes.format(d=digests, p='2 * i - 1')}) * 16 + {hexes.format(d=digests, p='2 * i')})"
    letters = (
        f"[substr('abcdefghijklmnopqrstuvwxyz0123456789', ({byte}) % 36 + 1, 1) "
        f"for i in range(1, length({value}) + 1)]"
    )
    return f"CASE WHEN {value} IS NULL THEN NULL ELSE array_to_string({letters}, '') END"


def initials(text: str) -> str:
    return f"upper(array_to_string([w[1] for w in string_split(trim({text}), ' ')], ''))"


def trailing(code: str, pattern: str = r"(\d+)$") -> str:
    return f"nullif(regexp_extract({code}, '{pattern}', 1), '')::BIGINT"


CLEAN = "upper(trim({0}, E' \\t'))"
_SKU = "lpad(regexp_extract(p_brand, '(\\d+)$', 1), 2, '0') || lpad(p_partkey::VARCHAR, greatest(9, length(p_partkey::VARCHAR))::INTEGER, '0')"
_SHIPPED = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END"
_WEIGHT = "(l_quantity::BIGINT * p_size)::DECIMAL(18,4)::VARCHAR"
_BATCH = "CASE l_linestatus WHEN 'O' THEN '20260715_181006_000001' WHEN 'F' THEN '20260708_170000_000002' END"
_INGESTED = "CASE l_linestatus WHEN 'O' THEN '2026-07-15T18:10:06' WHEN 'F' THEN '2026-07-08T17:00:00' END"
_RUN = "CASE l_returnflag WHEN 'A' THEN '20260901_020000' WHEN 'N' THEN '20260908_020000' WHEN 'R' THEN '20260915_032626' END"
_SNAPSHOT = "CASE l_linestatus WHEN 'O' THEN '20260710' WHEN 'F' THEN '20260709' END"
_CATEGORY = "p_type || ' ' || split_part(p_name, ' ', 2)"
_SHARED = f"""
  'N' || lpad(c_nationkey::VARCHAR, 2, '0') AS company_code,
  c_custkey::VARCHAR AS source_customer_code,
  (c_custkey % 7)::VARCHAR AS ship_to_customer_code,
  CASE WHEN l_returnflag = 'N' THEN ' ' || c_name || chr(9) ELSE lower(c_name) END AS customer_name,
  'PO-' || o_orderkey AS purchase_order_number,
  o_orderkey::VARCHAR AS order_number,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN substr(o_orderpriority, 1, 1) END AS order_type,
  o_orderstatus AS order_status,
  substr(sku, 1, 6) || '-' || substr(sku, 7) AS full_sku_code,
  substr(sku, 1, 6) AS first_half_sku_code,
  substr(sku, 7) AS unique_sku_code,
  p_name || ' ' || p_partkey AS product_description,
  l_quantity::BIGINT::VARCHAR AS final_order_quantity,
  ({_SHIPPED})::VARCHAR AS shipped_order_quantity,
  {_WEIGHT} AS shipped_order_weight,
  c_nationkey::VARCHAR AS delivery_route,
  {_BATCH} AS batch_id,
  {_INGESTED} AS ingested_at_datetime,
  line_row AS source_file_row_number
"""
_JOINED = """
  left join orders on l_orderkey = o_orderkey
  left join customer on o_custkey = c_custkey
  left join nation on c_nationkey = n_nationkey
  left join (select *, {sku} as sku from part) p on l_partkey = p_partkey
  left join supplier on l_suppkey = s_suppkey
""".format(sku=_SKU)


def _open_day(value: str) -> str:
    return f"CASE WHEN o_orderpriority = '5-LOW' THEN '0' ELSE {value} END"


_HISTORY_FLAGS = (
    "original_product_description_removed", "original_product_category_removed", "original_customer_name_removed",
    "original_sku_codes_removed",
)
_STAGE = """
  TIMESTAMP '2026-09-15 03:20:00' AS standardized_at, TIMESTAMP '2026-09-15 03:26:45' AS pseudonymized_at,
  source_filename, source_file_row_number, TIMESTAMP '2026-09-15 03:26:45' AS source_file_last_modified,
  TIMESTAMP '2026-09-15 04:00:00' AS ingested_at
"""
_SHORT_DAY = """strptime(CASE WHEN lpad(shipped_date, 6, '0')[5:6] >= '70' THEN '19' ELSE '20' END
    || lpad(shipped_date, 6, '0')[5:6] || lpad(shipped_date, 6, '0')[1:4], '%Y%m%d')::DATE"""

TABLES: dict[str, str] = {
    "lines": "select *, row_number() over () as line_row from lineitem",
    "history_lines": "select *, 0 as copy from lines union all "
    "select *, 1 as copy from lines where l_discount = 0 and l_tax = 0",
    "oh": f"""select {_SHARED},
  strftime(o_orderdate, '%Y%m%d') AS order_date,
  strftime(l_shipdate, '%Y%m%d') AS scheduled_ship_date,
  regexp_replace(strftime(l_shipdate, '%m%d%y'), '^0', '') AS shipped_date,
  'u' || (l_suppkey % 9) AS created_by_user,
  l_quantity::BIGINT::VARCHAR AS ordered_quantity,
  l_quantity::BIGINT::VARCHAR AS secondary_order_quantity,
  (l_quantity::BIGINT - {_SHIPPED})::VARCHAR AS quantity_short,
  (CASE WHEN l_returnflag = 'R' THEN -(l_extendedprice::DECIMAL(18,4)) ELSE l_extendedprice::DECIMAL(18,4) END)::DECIMAL(18,4)::VARCHAR AS order_amount,
  CASE WHEN l_linestatus = 'F' THEN {_CATEGORY} ELSE ' ' || lower({_CATEGORY}) END AS product_category,
  'order_history/batch_id=' || CASE WHEN copy = 1 THEN '20260922_041500' ELSE {_RUN} END || '/lineitem.parquet' AS source_filename
  from history_lines {_JOINED}""",
    "oo": f"""select {_SHARED},
  {_open_day("strftime(o_orderdate, '%Y%m%d')")} AS order_date,
  {_open_day("strftime(l_shipdate, '%Y%m%d')")} AS scheduled_ship_date,
  {_open_day("strftime(l_shipdate, '%Y%m%d')")} AS customer_requested_date,
  {_open_day("strftime(l_shipdate, '%Y%m%d')")} AS revised_delivery_date,
  {_WEIGHT} AS estimated_order_weight,
  c_name || ' - ' || n_name AS delivery_route_name,
  '0.0000' AS order_amount,
  'open_orders/batch_id=' || {_RUN} || '/lineitem.parquet' AS source_filename
  from lines {_JOINED}""",
    "inv": f"""select
  regexp_replace(sku, '^0+', '') || CASE WHEN l_returnflag = 'R' THEN '.0' ELSE '' END AS raw_sku,
  p_name || ' ' || p_partkey AS product_description,
  l_orderkey::VARCHAR AS pallet_number, l_suppkey::VARCHAR AS lot_number, l_linenumber::VARCHAR AS slot_location,
  l_returnflag AS pallet_held_flag,
  strftime(o_orderdate, '%Y%m%d') AS production_date, strftime(l_shipdate, '%Y%m%d') AS best_before_date,
  (CASE WHEN l_linestatus = 'O' THEN l_quantity::BIGINT ELSE 0 END)::VARCHAR AS reserved_quantity,
  l_quantity::BIGINT::VARCHAR AS quantity_on_hand, {_WEIGHT} AS weight,
  lpad(s_nationkey::VARCHAR, 2, '0') AS warehouse_code, {_SNAPSHOT} AS snapshot_date,
  substr(sku, 1, 6) || '-' || substr(sku, 7) AS full_sku_code,
  'inventory/snapshot_date=' || {_SNAPSHOT} || '/lineitem.parquet' AS source_filename,
  line_row AS source_file_row_number
  from lines {_JOINED}""",
    # published rows
    "raw_oh": f"""select company_code, order_number, purchase_order_number, customer_name, delivery_route, order_type,
  order_status, full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category, batch_id,
  strptime(order_date, '%Y%m%d')::DATE AS order_date,
  strptime(scheduled_ship_date, '%Y%m%d')::DATE AS scheduled_ship_date,
  {_SHORT_DAY} AS shipped_date,
  ordered_quantity::BIGINT AS ordered_quantity, secondary_order_quantity::BIGINT AS secondary_order_quantity,
  final_order_quantity::BIGINT AS final_order_quantity, shipped_order_quantity::BIGINT AS shipped_order_quantity,
  quantity_short::BIGINT AS quantity_short, shipped_order_weight::DECIMAL(18,4) AS shipped_order_weight,
  order_amount::DECIMAL(18,4) AS order_amount,
  {", ".join(f"true AS {flag}" for flag in _HISTORY_FLAGS)},
  NOT contains(source_filename, '20260922_041500') AS original_purchase_order_number_removed,
  CASE WHEN NOT contains(source_filename, '20260922_041500') THEN true END AS original_company_code_removed,
  {md5_of(HISTORY_FINGERPRINT)} AS row_hash,
  ingested_at_datetime::TIMESTAMP AS ingested_at_datetime, {_STAGE} from oh""",
    "raw_oo": f"""select company_code, customer_name, purchase_order_number, order_number, order_type, order_status,
  full_sku_code, first_half_sku_code, unique_sku_code, product_description, 'Unconfirmed' AS product_category,
  true AS product_category_derived, delivery_route_name, delivery_route,
  order_date::BIGINT AS order_date, scheduled_ship_date::BIGINT AS scheduled_ship_date,
  customer_requested_date::BIGINT AS customer_requested_date, revised_delivery_date::BIGINT AS revised_delivery_date,
  final_order_quantity::BIGINT AS final_order_quantity, shipped_order_quantity::BIGINT AS shipped_order_quantity,
  estimated_order_weight::DECIMAL(18,4) AS estimated_order_weight,
  shipped_order_weight::DECIMAL(18,4) AS shipped_order_weight, order_amount::DECIMAL(18,4) AS order_amount, batch_id,
  true AS original_product_description_removed, true AS original_customer_name_removed,
  true AS original_sku_codes_removed, true AS original_delivery_route_name_removed,
  true AS original_purchase_order_number_removed, true AS original_company_code_removed,
  {md5_of(OPEN_FINGERPRINT)} AS row_hash,
  ingested_at_datetime::TIMESTAMP AS ingested_at_datetime, {_STAGE} from oo""",
    "raw_inv": f"""select warehouse_code, strptime(snapshot_date, '%Y%m%d')::DATE AS snapshot_date, full_sku_code,
  product_description, 'Unconfirmed' AS product_category, true AS product_category_derived, pallet_number, lot_number,
  slot_location, pallet_held_flag, production_date, best_before_date, reserved_quantity::BIGINT AS reserved_quantity,
  quantity_on_hand::BIGINT AS quantity_on_hand, weight::DECIMAL(18,4) AS weight,
  true AS original_product_description_removed, true AS original_sku_removed, true AS original_warehouse_code_removed,
  {md5_of(INVENTORY_FINGERPRINT)} AS row_hash, {_STAGE} from inv""",
    # impossible dates planted in published open orders
    "bad_oo": "select * replace (CASE WHEN final_order_quantity = 50 THEN 20260230 ELSE order_date END AS order_date) from raw_oo",
    "stg_oh": """select company_code, order_number, purchase_order_number, customer_name, full_sku_code,
  first_half_sku_code, unique_sku_code, product_description, product_category, delivery_route, order_type,
  order_status, order_date, scheduled_ship_date, shipped_date, ordered_quantity, secondary_order_quantity,
  final_order_quantity, shipped_order_quantity, quantity_short, shipped_order_weight,
  original_product_description_removed, original_product_category_removed, original_customer_name_removed,
  original_sku_codes_removed, original_purchase_order_number_removed, original_company_code_removed, batch_id,
  row_hash, ingested_at_datetime AS source_ingested_at, standardized_at, pseudonymized_at, source_filename,
  source_file_row_number, source_file_last_modified, ingested_at AS loaded_at from raw_oh""",
}
_DAYS = ("order_date", "scheduled_ship_date", "customer_requested_date", "revised_delivery_date")


def open_day(column: str) -> str:
    return f"try_strptime(nullif({column}, 0)::VARCHAR, '%Y%m%d')::DATE"


def stg_open(source: str) -> str:
    days = ", ".join(f"{open_day(d)} AS {d}" for d in _DAYS)
    return f"""select company_code, customer_name, purchase_order_number, order_number::VARCHAR AS order_number,
  order_type, order_status::VARCHAR AS order_status, full_sku_code, first_half_sku_code, unique_sku_code,
  product_description, product_category, product_category_derived, delivery_route_name,
  delivery_route::VARCHAR AS delivery_route, {days}, final_order_quantity, shipped_order_quantity,
  estimated_order_weight, shipped_order_weight, batch_id, original_product_description_removed,
  original_customer_name_removed, original_sku_codes_removed, original_delivery_route_name_removed,
  original_purchase_order_number_removed, original_company_code_removed, row_hash,
  ingested_at_datetime AS source_ingested_at, standardized_at, pseudonymized_at, source_filename,
  source_file_row_number, source_file_last_modified, ingested_at AS loaded_at from {source}"""


TABLES["stg_oo"] = stg_open("raw_oo")
TABLES["stg_bad_oo"] = stg_open("bad_oo")

# --- identities ---------------------------------------------------------------------------


def _identity(rows: str) -> str:
    src, ship, name = (CLEAN.format(c) for c in ("source_customer_code", "ship_to_customer_code", "customer_name"))
    return f"""select distinct md5({src} || '|' || {ship} || '|' || {name}) AS customer_hash_key,
  {src} AS source_customer_code, {ship} AS ship_to_customer_code, {name} AS customer_name from {rows}"""


def _continue(keys: str, prior: str, key: str, code: str, prefix: str, width: int) -> str:
    """prior mapping plus codes for keys it lacks, in key order after its greatest number."""
    number = f"((select coalesce(max({trailing(code)}), 0) from {prior}) + row_number() over (order by k.{key}))::VARCHAR"
    return (
        f"select {key}, {code} from {prior} where {code} is not null union all "
        f"select k.{key}, '{prefix}' || {pad(number, width)} AS {code} from {keys} k "
        f"where k.{key} not in (select {key} from {prior} where {code} is not null)"
    )


def _first(rows: str, key: str, columns: str) -> str:
    return f"""select {key}, {columns} from (select *, row_number() over (partition by {key}
  order by source_filename, source_file_row_number) AS rn from {rows}) where rn = 1"""


_PRODUCT = "first_half_sku_code, unique_sku_code, product_description, product_category"


def _categorized(base: str) -> str:
    return f"""select full_sku_code, first_half_sku_code, unique_sku_code, trim(product_description) AS product_description,
  upper(trim(b.product_category)) AS product_category, pseudo_category
  from {base} b left join category_map m on upper(trim(b.product_category)) = m.category"""


def _named(rows: str, prior: str | None) -> str:
    last = "0" if prior is None else "coalesce(m.last, 0)"
    join = "" if prior is None else (
        f"left join (select pseudo_category, max({trailing('pseudo_product_description', '-(\\d+)$')}) AS last "
        f"from {prior} group by 1) m using (pseudo_category)"
    )
    number = f"({last} + row_number() over (partition by pseudo_category order by product_description, full_sku_code))::VARCHAR"
    return f"""select full_sku_code, {_PRODUCT}, pseudo_category,
  pseudo_category || ' Product ' || {initials('pseudo_category')} || '-' || {pad(number, 3)} AS pseudo_product_description
  from {rows} {join}"""


TABLES.update(
    {
        "prior_oh": "select * from oh where order_date < '19950701'",
        "prior_customer_base": _identity("prior_oh"),
        "customer_base": _identity("oh"),
        "no_customers": "select '' AS customer_hash_key, NULL::VARCHAR AS pseudo_customer_name where false",
        "prior_customer_codes": _continue(
            "prior_customer_base", "no_customers", "customer_hash_key", "pseudo_customer_name", "Customer CUST-", 6
        ),
        "customer_codes": _continue(
            "customer_base", "prior_customer_codes", "customer_hash_key", "pseudo_customer_name", "Customer CUST-", 6
        ),
        "prior_customers": "select b.*, pseudo_customer_name from prior_customer_base b "
        "join prior_customer_codes using (customer_hash_key)",
        "customers": "select b.*, pseudo_customer_name from customer_base b join customer_codes using (customer_hash_key)",
        # routes
        "prior_route_base": "select distinct trim(delivery_route_name) AS delivery_route_name from oo where order_date < '19950701'",
        "route_base": "select distinct trim(delivery_route_name) AS delivery_route_name from oo",
        "no_routes": "select '' AS delivery_route_name, NULL::VARCHAR AS pseudo_delivery_route_name where false",
        "prior_routes": _continue(
            "prior_route_base", "no_routes", "delivery_route_name", "pseudo_delivery_route_name", "Route RT-", 6
        ),
        "routes": _continue(
            "route_base", "prior_routes", "delivery_route_name", "pseudo_delivery_route_name", "Route RT-", 6
        ),
        # products
        "category_map": """select distinct upper(p_type || ' ' || split_part(p_name, ' ', 2)) AS category,
  upper(p_type[1]) || lower(p_type[2:]) || ' ' || upper(split_part(p_name, ' ', 2)[1])
  || lower(split_part(p_name, ' ', 2)[2:]) || ' Line' AS pseudo_category from part""",
        "prior_product_base": _first("prior_oh", "full_sku_code", _PRODUCT),
        "product_base": _first("oh", "full_sku_code", _PRODUCT),
        "prior_named": _named("prior_categorized", None),
        "prior_categorized": _categorized("prior_product_base"),
        "no_prefixes": "select '' AS pseudo_category, '' AS prefix where false",
        "prior_prefixes": f"""select pseudo_category, {initials('pseudo_category')} || CASE WHEN n > 1 THEN n::VARCHAR ELSE '' END AS prefix
  from (select pseudo_category, row_number() over (partition by {initials('pseudo_category')} order by pseudo_category) AS n
  from (select distinct pseudo_category from prior_named))""",
        "prior_full": f"""select n.*, 'SKU-' || prefix || '-' || {pad("(row_number() over (partition by pseudo_category order by pseudo_product_description, full_sku_code))::VARCHAR", 6)} AS pseudo_full_sku_code
  from prior_named n join prior_prefixes using (pseudo_category)""",
        "no_groups": "select '' AS first_half_sku_code, NULL::VARCHAR AS pseudo_first_half_sku_code where false",
        "no_bases": "select '' AS unique_sku_code, NULL::VARCHAR AS pseudo_unique_sku_code where false",
        "prior_group_keys": "select distinct first_half_sku_code from prior_full",
        "prior_base_keys": "select distinct unique_sku_code from prior_full",
        "prior_groups": _continue("prior_group_keys", "no_groups", "first_half_sku_code", "pseudo_first_half_sku_code", "SKU-GRP-", 5),
        "prior_bases": _continue("prior_base_keys", "no_bases", "unique_sku_code", "pseudo_unique_sku_code", "SKU-BASE-", 5),
        "prior_products": """select f.*, pseudo_first_half_sku_code, pseudo_unique_sku_code from prior_full f
  join prior_groups using (first_half_sku_code) join prior_bases using (unique_sku_code)""",
        "fresh_categorized": "select * from ("
        + _categorized("product_base")
        + ") where full_sku_code not in (select full_sku_code from prior_products)",
        "fresh_named": _named("fresh_categorized", "prior_products"),
        "named": "select * from prior_products union all by name select * from fresh_named",
        "prefixes": f"""select pseudo_category, prefix from prior_prefixes union all
  select pseudo_category, base || CASE WHEN used + n > 1 THEN (used + n)::VARCHAR ELSE '' END AS prefix from (
    select c.pseudo_category, {initials('c.pseudo_category')} AS base,
      row_number() over (partition by {initials('c.pseudo_category')} order by c.pseudo_category) AS n,
      (select count(*) from prior_prefixes p where {initials('p.pseudo_category')} = {initials('c.pseudo_category')}) AS used
    from (select distinct pseudo_category from named) c
    where c.pseudo_category not in (select pseudo_category from prior_prefixes))""",
        "full_skus": f"""select full_sku_code, pseudo_category, pseudo_full_sku_code from prior_products union all
  select n.full_sku_code, n.pseudo_category, 'SKU-' || prefix || '-' || {pad("(coalesce(last, 0) + row_number() over (partition by n.pseudo_category order by n.pseudo_product_description, n.full_sku_code))::VARCHAR", 6)} AS pseudo_full_sku_code
  from fresh_named n join prefixes using (pseudo_category)
  left join (select pseudo_category, max({trailing('pseudo_full_sku_code', '-(\\d+)$')}) AS last from prior_products group by 1) m using (pseudo_category)""",
        "group_keys": "select distinct first_half_sku_code from named",
        "base_keys": "select distinct unique_sku_code from named",
        "groups": _continue("group_keys", "prior_groups", "first_half_sku_code", "pseudo_first_half_sku_code", "SKU-GRP-", 5),
        "bases": _continue("base_keys", "prior_bases", "unique_sku_code", "pseudo_unique_sku_code", "SKU-BASE-", 5),
        "products": """select n.full_sku_code, n.first_half_sku_code, n.unique_sku_code, n.product_description,
  n.product_category, n.pseudo_category, n.pseudo_product_description, s.pseudo_full_sku_code,
  g.pseudo_first_half_sku_code, b.pseudo_unique_sku_code
  from (select full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category,
    pseudo_category, pseudo_product_description from named) n
  join full_skus s using (full_sku_code) join groups g using (first_half_sku_code) join bases b using (unique_sku_code)""",
    }
)


def backfill(fresh: str, existing: str) -> dict[str, str]:
    """Blocks that append ``fresh`` to ``existing`` as the Unknown category; result ``filled_<fresh>``."""
    tag = fresh
    prefix = f"(select coalesce(min(CASE WHEN pseudo_category = 'Unknown Category' THEN regexp_extract(pseudo_full_sku_code, '^SKU-([A-Z0-9]+)-\\d+$', 1) END), 'UC') from {existing})"
    last_text = f"(select coalesce(max({trailing('pseudo_product_description', '-(\\d+)$')}), 0) from {existing} where pseudo_category = 'Unknown Category')"
    last_sku = f"(select coalesce(max({trailing('pseudo_full_sku_code')}), 0) from {existing} where regexp_extract(pseudo_full_sku_code, '^SKU-([A-Z0-9]+)-\\d+$', 1) = {prefix})"
    order = "row_number() over (order by full_sku_code)"
    columns = (
        "full_sku_code, first_half_sku_code, unique_sku_code, product_description, product_category, pseudo_category, "
        "pseudo_product_description, pseudo_full_sku_code, pseudo_first_half_sku_code, pseudo_unique_sku_code"
    )
    return {
        f"known_groups_{tag}": f"select distinct first_half_sku_code, pseudo_first_half_sku_code from {existing}",
        f"known_bases_{tag}": f"select distinct unique_sku_code, pseudo_unique_sku_code from {existing}",
        f"want_groups_{tag}": f"select distinct first_half_sku_code from {fresh}",
        f"want_bases_{tag}": f"select distinct unique_sku_code from {fresh}",
        f"groups_{tag}": _continue(f"want_groups_{tag}", f"known_groups_{tag}", "first_half_sku_code", "pseudo_first_half_sku_code", "SKU-GRP-", 5),
        f"bases_{tag}": _continue(f"want_bases_{tag}", f"known_bases_{tag}", "unique_sku_code", "pseudo_unique_sku_code", "SKU-BASE-", 5),
        f"added_{tag}": f"""select full_sku_code, first_half_sku_code, unique_sku_code, product_description,
  'UNKNOWN' AS product_category, 'Unknown Category' AS pseudo_category,
  'Unknown Category Product UC-' || {pad(f"({last_text} + {order})::VARCHAR", 3)} AS pseudo_product_description,
  'SKU-' || {prefix} || '-' || {pad(f"({last_sku} + {order})::VARCHAR", 6)} AS pseudo_full_sku_code from {fresh}""",
        f"filled_{tag}": f"select {columns} from {existing} union all select {columns} from added_{tag} "
        f"join groups_{tag} using (first_half_sku_code) join bases_{tag} using (unique_sku_code)",
    }


_RESTORED = (
    "substr({d}, 1, 6) || '-' || substr({d}, 7)".format(d="lpad(regexp_replace(trim(raw_sku), '\\.0$', ''), greatest(11, length(regexp_replace(trim(raw_sku), '\\.0$', '')))::INTEGER, '0')")
)
TABLES.update(
    {
        "opened": "select * from ("
        + _first("oo", "full_sku_code", "first_half_sku_code, unique_sku_code, product_description")
        + ") where full_sku_code not in (select full_sku_code from prior_products)",
        "every_opened": "select * from oo",
        "opened_half": "select * from ("
        + _first("every_opened", "full_sku_code", "first_half_sku_code, unique_sku_code, product_description")
        + ") where full_sku_code not in (select full_sku_code from prior_products)",
        "restored": f"select *, {_RESTORED} AS full_sku from inv",
        "stock_base": """select full_sku AS full_sku_code, split_part(full_sku, '-', 1) AS first_half_sku_code,
  split_part(full_sku, '-', 2) AS unique_sku_code, product_description from (select *, row_number() over
  (partition by full_sku order by source_filename, source_file_row_number) AS rn from restored) where rn = 1""",
        "stocked": "select * from stock_base where full_sku_code not in (select full_sku_code from prior_products)",
        "stocked_late": "select * from stock_base where full_sku_code not in (select full_sku_code from filled_opened_half)",
        **backfill("opened", "prior_products"),
        **backfill("opened_half", "prior_products"),
        **backfill("stocked_late", "filled_opened_half"),
    }
)

# --- pseudonymized batches ----------------------------------------------------------------

_KEY = "md5({} || '|' || {} || '|' || {})".format(
    *(CLEAN.format(c) for c in ("source_customer_code", "ship_to_customer_code", "customer_name"))
)
_SWAPPED = """replace (p.pseudo_product_description AS product_description, c.pseudo_customer_name AS customer_name,
  p.pseudo_full_sku_code AS full_sku_code, p.pseudo_first_half_sku_code AS first_half_sku_code,
  p.pseudo_unique_sku_code AS unique_sku_code, {po} AS purchase_order_number, {company} AS company_code{more})"""
_NORMAL = {"source_customer_code": CLEAN.format("source_customer_code"), "ship_to_customer_code": CLEAN.format("ship_to_customer_code")}
_SWAP = dict(po=pseudonym("f.purchase_order_number"), company=pseudonym("f.company_code"))
_AT = "TIMESTAMP '2026-09-15 03:26:45' AS pseudonymized_at"


def _true(*names: str) -> str:
    return ", ".join(f"true AS original_{n}_removed" for n in names)


TABLES.update(
    {
        "keyed_oh": f"select *, {_KEY} AS customer_hash_key from oh",
        "keyed_oo": f"select *, {_KEY} AS customer_hash_key from oo",
        "swapped_oh": f"""select f.* {_SWAPPED.format(more=", p.pseudo_category AS product_category", **_SWAP)}
  from keyed_oh f left join products p on f.full_sku_code = p.full_sku_code
  left join customers c on f.customer_hash_key = c.customer_hash_key""",
        "pseudo_oh": f"""select * exclude (source_customer_code, ship_to_customer_code, created_by_user, customer_hash_key,
    source_filename, source_file_row_number),
  {_true("product_description", "product_category", "customer_name", "sku_codes", "purchase_order_number", "company_code")},
  {md5_of(HISTORY_FINGERPRINT, **_NORMAL)} AS row_hash, {_AT} from swapped_oh""",
        "swapped_oo": f"""select f.* {_SWAPPED.format(more=", r.pseudo_delivery_route_name AS delivery_route_name", **_SWAP)},
  p.pseudo_category AS product_category
  from keyed_oo f left join products p on f.full_sku_code = p.full_sku_code
  left join customers c on f.customer_hash_key = c.customer_hash_key
  left join routes r on trim(f.delivery_route_name) = r.delivery_route_name""",
        "pseudo_oo": f"""select * exclude (source_customer_code, ship_to_customer_code, customer_hash_key, source_filename,
    source_file_row_number),
  {_true("product_description", "customer_name", "sku_codes", "delivery_route_name", "purchase_order_number", "company_code")},
  true AS product_category_derived, {md5_of(OPEN_FINGERPRINT, **_NORMAL)} AS row_hash, {_AT} from swapped_oo""",
        "swapped_inv": f"""select f.* exclude (full_sku_code, full_sku, raw_sku)
  replace (p.pseudo_product_description AS product_description, {pseudonym("f.warehouse_code")} AS warehouse_code),
  p.pseudo_full_sku_code AS full_sku_code, p.pseudo_category AS product_category
  from restored f left join products p on f.full_sku = p.full_sku_code""",
        "pseudo_inv": f"""select * exclude (source_filename, source_file_row_number),
  {_true("product_description", "sku", "warehouse_code")}, true AS product_category_derived,
  {md5_of(INVENTORY_FINGERPRINT)} AS row_hash, {_AT} from swapped_inv""",
    }
)


def compose(sql: str, materialized: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with the blocks it names, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in TABLES:
            if name not in order and re.search(rf"\b(?:from|join)\s+{name}\b", text, re.IGNORECASE):
                need(TABLES[name])
                if name not in order:
                    order.append(name)

    need(sql)
    blocks = ",\n".join(f"{name} AS {'MATERIALIZED ' if name in materialized else ''}({TABLES[name]})" for name in order)
    return f"WITH {blocks}\n{sql}" if blocks else sql
