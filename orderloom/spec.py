"""What each of the three datasets looks like: headers, rules and published types."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Source headers and their readable names, per dataset.
ORDER_HISTORY_HEADERS = {
    "comp_cd": "company_code",
    "src_cust_cd": "source_customer_code",
    "ship_cust_cd": "ship_to_customer_code",
    "ship_cust_nm": "customer_name",
    "po_no": "purchase_order_number",
    "ord_no": "order_number",
    "ord_type": "order_type",
    "ord_dt": "order_date",
    "sched_ship_dt": "scheduled_ship_date",
    "ship_dt": "shipped_date",
    "created_by": "created_by_user",
    "route_cd": "delivery_route",
    "ord_status": "order_status",
    "ord_qty": "ordered_quantity",
    "sku_full": "full_sku_code",
    "sku_prefix": "first_half_sku_code",
    "sku_item": "unique_sku_code",
    "item_desc": "product_description",
    "ord_qty_2": "secondary_order_quantity",
    "final_qty": "final_order_quantity",
    "ship_qty": "shipped_order_quantity",
    "qty_short": "quantity_short",
    "ship_wt": "shipped_order_weight",
    "ord_amt": "order_amount",
    "item_cat": "product_category",
    "batch_id": "batch_id",
    "ingested_at": "ingested_at_datetime",
}
OPEN_ORDERS_HEADERS = {
    "comp_cd": "company_code",
    "src_cust_cd": "source_customer_code",
    "ship_cust_cd": "ship_to_customer_code",
    "ship_cust_nm": "customer_name",
    "po_no": "purchase_order_number",
    "ord_no": "order_number",
    "ord_dt": "order_date",
    "sched_ship_dt": "scheduled_ship_date",
    "ord_status": "order_status",
    "sku_prefix": "first_half_sku_code",
    "sku_item": "unique_sku_code",
    "item_desc": "product_description",
    "final_qty": "final_order_quantity",
    "ship_qty": "shipped_order_quantity",
    "ord_type": "order_type",
    "est_wt": "estimated_order_weight",
    "route_nm": "delivery_route_name",
    "route_cd": "delivery_route",
    "req_dt": "customer_requested_date",
    "rev_dlv_dt": "revised_delivery_date",
    "ship_wt": "shipped_order_weight",
    "sku_full": "full_sku_code",
    "ord_amt": "order_amount",
    "batch_id": "batch_id",
    "ingested_at": "ingested_at_datetime",
}
OPEN_ORDERS_DROPS = ("sched_ship_dt_alt", "ord_val", "created_by")
INVENTORY_HEADERS = {
    "sku": "raw_sku",
    "description": "product_description",
    "pallet_no.": "pallet_number",
    "lot_no.": "lot_number",
    "slot": "slot_location",
    "pallet_held": "pallet_held_flag",
    "prod'n_date": "production_date",
    "bb_date": "best_before_date",
    "res_qty": "reserved_quantity",
    "qty": "quantity_on_hand",
    "wgt": "weight",
}
INVENTORY_TAGS = ("warehouse_code", "snapshot_date")

# Columns of the row fingerprints, in order.
ORDER_HISTORY_FINGERPRINT = (
    "company_code", "source_customer_code", "ship_to_customer_code", "customer_name",
    "purchase_order_number", "order_number", "order_type", "order_date", "scheduled_ship_date",
    "shipped_date", "delivery_route", "order_status", "ordered_quantity", "full_sku_code",
    "first_half_sku_code", "unique_sku_code", "final_order_quantity", "shipped_order_quantity",
    "quantity_short", "shipped_order_weight", "order_amount", "product_category",
    "product_description",
)
OPEN_ORDERS_FINGERPRINT = (
    "company_code", "source_customer_code", "ship_to_customer_code", "customer_name",
    "purchase_order_number", "order_number", "order_type", "order_date", "scheduled_ship_date",
    "order_status", "full_sku_code", "first_half_sku_code", "unique_sku_code",
    "final_order_quantity", "shipped_order_quantity", "estimated_order_weight",
    "shipped_order_weight", "delivery_route", "delivery_route_name", "customer_requested_date",
    "revised_delivery_date", "order_amount", "product_description",
)
INVENTORY_FINGERPRINT = (
    "warehouse_code", "snapshot_date", "full_sku_code", "pallet_number", "lot_number",
    "slot_location", "production_date", "best_before_date", "reserved_quantity",
    "quantity_on_hand", "weight",
)

# Identity, product and lineage columns, and the schemas of mappings and publications.
IDENTITY_COLUMNS = ("source_customer_code", "ship_to_customer_code", "customer_name")
PRODUCT_COLUMNS = (
    "full_sku_code", "first_half_sku_code", "unique_sku_code", "product_description",
    "product_category",
)
PSEUDO_SKU_COLUMNS = (
    "pseudo_full_sku_code", "pseudo_first_half_sku_code", "pseudo_unique_sku_code",
)
LINEAGE_COLUMNS = (
    "source_filename", "source_file_row_number", "source_file_last_modified", "ingested_at",
)

TEXT = T.StringType()
WHOLE = T.DecimalType(38, 0)
MEASURE = T.DecimalType(18, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CUSTOMER_MAPPING_SCHEMA = _struct(
    customer_hash_key=TEXT, source_customer_code=TEXT, ship_to_customer_code=TEXT,
    customer_name=TEXT, pseudo_customer_name=TEXT,
)
ROUTE_MAPPING_SCHEMA = _struct(delivery_route_name=TEXT, pseudo_delivery_route_name=TEXT)
CATEGORY_MAPPING_SCHEMA = _struct(product_category=TEXT, pseudo_category=TEXT)
PRODUCT_MAPPING_SCHEMA = _struct(
    full_sku_code=TEXT, first_half_sku_code=TEXT, unique_sku_code=TEXT, product_description=TEXT,
    product_category=TEXT, pseudo_category=TEXT, pseudo_product_description=TEXT,
    pseudo_full_sku_code=TEXT, pseudo_first_half_sku_code=TEXT, pseudo_unique_sku_code=TEXT,
)

_LINEAGE = dict(
    source_filename=TEXT, source_file_row_number=T.LongType(),
    source_file_last_modified=T.TimestampNTZType(), ingested_at=T.TimestampType(),
)
_STAGE_TIMES = dict(
    ingested_at_datetime=T.TimestampNTZType(), standardized_at=T.TimestampNTZType(),
    pseudonymized_at=T.TimestampNTZType(),
)
_FLAG = T.BooleanType()
PUBLISHED_ORDER_HISTORY = _struct(
    company_code=TEXT, order_number=TEXT, purchase_order_number=TEXT, customer_name=TEXT,
    delivery_route=TEXT, order_type=TEXT, order_status=TEXT, full_sku_code=TEXT,
    first_half_sku_code=TEXT, unique_sku_code=TEXT, product_description=TEXT,
    product_category=TEXT, batch_id=TEXT,
    order_date=T.DateType(), scheduled_ship_date=T.DateType(), shipped_date=T.DateType(),
    ordered_quantity=WHOLE, secondary_order_quantity=WHOLE, final_order_quantity=WHOLE,
    shipped_order_quantity=WHOLE, quantity_short=WHOLE, shipped_order_weight=MEASURE,
    order_amount=MEASURE,
    original_product_description_removed=_FLAG, original_product_category_removed=_FLAG,
    original_customer_name_removed=_FLAG, original_sku_codes_removed=_FLAG,
    original_purchase_order_number_removed=_FLAG, original_company_code_removed=_FLAG,
    row_hash=TEXT, **_STAGE_TIMES, **_LINEAGE,
)
# Open-order dates stay numeric codes here; the staging view turns them into days.
PUBLISHED_OPEN_ORDERS = _struct(
    company_code=TEXT, customer_name=TEXT, purchase_order_number=TEXT, order_number=TEXT,
    order_type=TEXT, order_status=TEXT, full_sku_code=TEXT, first_half_sku_code=TEXT,
    unique_sku_code=TEXT, product_description=TEXT, product_category=TEXT,
    product_category_derived=_FLAG, delivery_route_name=TEXT, delivery_route=TEXT,
    order_date=T.LongType(), scheduled_ship_date=T.LongType(),
    customer_requested_date=T.LongType(), revised_delivery_date=T.LongType(),
    final_order_quantity=WHOLE, shipped_order_quantity=WHOLE, estimated_order_weight=MEASURE,
    shipped_order_weight=MEASURE, order_amount=MEASURE, batch_id=TEXT,
    original_product_description_removed=_FLAG, original_customer_name_removed=_FLAG,
    original_sku_codes_removed=_FLAG, original_delivery_route_name_removed=_FLAG,
    original_purchase_order_number_removed=_FLAG, original_company_code_removed=_FLAG,
    row_hash=TEXT, **_STAGE_TIMES, **_LINEAGE,
)
PUBLISHED_INVENTORY = _struct(
    warehouse_code=TEXT, snapshot_date=T.DateType(), full_sku_code=TEXT, product_description=TEXT,
    product_category=TEXT, product_category_derived=_FLAG, pallet_number=TEXT, lot_number=TEXT,
    slot_location=TEXT, pallet_held_flag=TEXT, production_date=TEXT, best_before_date=TEXT,
    reserved_quantity=WHOLE, quantity_on_hand=WHOLE, weight=MEASURE,
    original_product_description_removed=_FLAG, original_sku_removed=_FLAG,
    original_warehouse_code_removed=_FLAG, row_hash=TEXT,
    standardized_at=T.TimestampNTZType(), pseudonymized_at=T.TimestampNTZType(), **_LINEAGE,
)


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset's rules. Deployments with other source headers pass their own copy."""

    name: str
    headers: dict[str, str]
    published: T.StructType
    partition_column: str
    batch_column: str
    identifier_pattern: str
    fingerprint: tuple[str, ...]
    gate_required: tuple[str, ...]
    gate_critical: tuple[str, ...]
    gate_numeric: tuple[str, ...]
    gate_patterns: tuple[tuple[str, str, str, str, str], ...]
    validator_required: tuple[str, ...]
    validator_patterns: tuple[tuple[str, str, str], ...]
    privacy_flags: tuple[str, ...]
    drops: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    warn_missing: bool = True
    date_columns: tuple[str, ...] = field(default=())

    def with_headers(self, headers: dict[str, str], drops: tuple[str, ...] | None = None) -> DatasetSpec:
        return replace(self, headers=headers, drops=self.drops if drops is None else drops)


# Fixed values: (check, metric, column, rule, expected text) of the pattern checks.
_CUSTOMER_CHECK = ("customer_pseudonymization", "bad_customer_rows", "customer_name", "starts", "Customer CUST-")
_PRODUCT_CHECK = ("product_pseudonymization", "bad_product_rows", "product_description", "contains", " Product ")
_SKU_CHECK = ("sku_pseudonymization", "bad_sku_rows", "full_sku_code", "starts", "SKU-")
_CUSTOMER_RULE = ("customer_name", "starts", "Customer CUST-")
_PRODUCT_RULE = ("product_description", "contains", " Product ")
_ROUTE_RULE = ("delivery_route_name", "starts", "Route RT-")
_SKU_RULE = ("full_sku_code", "starts", "SKU-")

# Fixed values below: required, critical and numeric columns of each gate and validator.
ORDER_HISTORY = DatasetSpec(
    name="order_history",
    headers=ORDER_HISTORY_HEADERS,
    published=PUBLISHED_ORDER_HISTORY,
    partition_column="source_filename",
    batch_column="batch_id",
    identifier_pattern=r"^\d{8}_\d{6}$",
    fingerprint=ORDER_HISTORY_FINGERPRINT,
    gate_required=(
        "company_code", "customer_name", "purchase_order_number", "order_number", "order_type",
        "order_date", "scheduled_ship_date", "shipped_date", "delivery_route", "order_status",
        "ordered_quantity", "full_sku_code", "product_description", "product_category",
        "row_hash", "pseudonymized_at",
    ),
    gate_critical=(
        "order_number", "full_sku_code", "customer_name", "product_description",
        "product_category", "row_hash",
    ),
    gate_numeric=(
        "ordered_quantity", "final_order_quantity", "shipped_order_quantity",
        "shipped_order_weight", "order_amount",
    ),
    gate_patterns=(_CUSTOMER_CHECK, _PRODUCT_CHECK),
    validator_required=(
        "customer_name", "product_description", "product_category", "row_hash", "pseudonymized_at",
    ),
    validator_patterns=(_CUSTOMER_RULE, _PRODUCT_RULE),
    privacy_flags=(
        "original_company_code_removed", "original_purchase_order_number_removed",
        "original_customer_name_removed", "original_sku_codes_removed",
        "original_product_description_removed", "original_product_category_removed",
    ),
    date_columns=("order_date", "scheduled_ship_date", "shipped_date"),
)
OPEN_ORDERS = DatasetSpec(
    name="open_orders",
    headers=OPEN_ORDERS_HEADERS,
    drops=OPEN_ORDERS_DROPS,
    published=PUBLISHED_OPEN_ORDERS,
    partition_column="source_filename",
    batch_column="batch_id",
    identifier_pattern=r"^\d{8}_\d{6}$",
    fingerprint=OPEN_ORDERS_FINGERPRINT,
    gate_required=(
        "company_code", "customer_name", "purchase_order_number", "order_number", "order_type",
        "order_date", "scheduled_ship_date", "order_status", "full_sku_code",
        "product_description", "product_category", "row_hash", "pseudonymized_at",
    ),
    gate_critical=("order_number", "full_sku_code", "customer_name", "product_description", "row_hash"),
    gate_numeric=(
        "final_order_quantity", "shipped_order_quantity", "estimated_order_weight",
        "shipped_order_weight", "order_amount",
    ),
    gate_patterns=(_CUSTOMER_CHECK, _PRODUCT_CHECK),
    validator_required=(
        "customer_name", "product_description", "product_category", "delivery_route_name",
        "row_hash", "pseudonymized_at",
    ),
    validator_patterns=(_CUSTOMER_RULE, _PRODUCT_RULE, _ROUTE_RULE),
    privacy_flags=(
        "original_company_code_removed", "original_purchase_order_number_removed",
        "original_customer_name_removed", "original_sku_codes_removed",
        "original_product_description_removed", "original_delivery_route_name_removed",
    ),
    date_columns=(
        "order_date", "scheduled_ship_date", "customer_requested_date", "revised_delivery_date",
    ),
)
INVENTORY = DatasetSpec(
    name="inventory",
    headers=INVENTORY_HEADERS,
    tags=INVENTORY_TAGS,
    warn_missing=False,
    published=PUBLISHED_INVENTORY,
    partition_column="snapshot_date",
    batch_column="snapshot_date",
    identifier_pattern=r"^\d{8}$",
    fingerprint=INVENTORY_FINGERPRINT,
    gate_required=(
        "warehouse_code", "snapshot_date", "full_sku_code", "product_description",
        "product_category", "quantity_on_hand", "row_hash", "pseudonymized_at",
    ),
    gate_critical=("full_sku_code", "product_description", "row_hash"),
    gate_numeric=("reserved_quantity", "quantity_on_hand", "weight"),
    gate_patterns=(_PRODUCT_CHECK, _SKU_CHECK),
    validator_required=(
        "product_description", "product_category", "full_sku_code", "row_hash", "pseudonymized_at",
    ),
    validator_patterns=(_PRODUCT_RULE, _SKU_RULE),
    privacy_flags=(
        "original_product_description_removed", "original_sku_removed",
        "original_warehouse_code_removed",
    ),
)
DATASETS = {spec.name: spec for spec in (ORDER_HISTORY, OPEN_ORDERS, INVENTORY)}
