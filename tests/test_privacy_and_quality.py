from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderloom.functions.hashing import customer_key
from orderloom.operators import privacy, quality
from orderloom.operators.guards import GuardError
from orderloom.spec import INVENTORY, OPEN_ORDERS, ORDER_HISTORY

AT = datetime(2026, 9, 15, 3, 26, 45)
SALT = "s"
ORDER = (
    "company_code source_customer_code ship_to_customer_code customer_name purchase_order_number order_number "
    "full_sku_code first_half_sku_code unique_sku_code product_description product_category created_by_user "
    "delivery_route_name ordered_quantity"
)
LINE = ("N1", "7", "1", " acme ", "PO-1", "42", "000012-00002 ", "000012", "00002", "steel", "rings", "bob", "acme - x", "5")
SECRETS = {"7", "acme", " acme ", "PO-1", "N1", "000012-00002", "000012-00002 ", "000012", "00002", "steel", "rings", "bob", "acme - x"}


@pytest.fixture
def products(values):
    return values(
        "full_sku_code pseudo_category pseudo_product_description pseudo_full_sku_code pseudo_first_half_sku_code pseudo_unique_sku_code",
        ("000012-00002", "Ring", "Ring Product R-001", "SKU-R-000001", "SKU-GRP-00001", "SKU-BASE-00001"),
    )


@pytest.fixture
def customers(values):
    key = customer_key(F.lit("7"), F.lit("1"), F.lit("ACME"))
    return values("pseudo_customer_name", ("Customer CUST-000001",)).withColumn("customer_hash_key", key)


@pytest.fixture
def routes(values):
    return values("delivery_route_name pseudo_delivery_route_name", ("acme - x", "Route RT-000001"))


def history(values, *lines):
    return values(ORDER, *(lines or (LINE,))).drop("delivery_route_name")


def opened(values, *lines):
    return values(ORDER, *(lines or (LINE,))).drop("created_by_user", "product_category", "ordered_quantity")


def test_no_real_identifier_survives(values, products, customers, routes):
    out = privacy.pseudonymize_order_history(history(values, LINE, LINE), products, customers, SALT, AT)
    assert not {"source_customer_code", "ship_to_customer_code", "created_by_user", "customer_hash_key"} & set(out.columns)
    for row in out.collect():
        assert not SECRETS & set(row)
        assert len(row.purchase_order_number) == 4 and len(row.company_code) == 2
        assert row.original_sku_codes_removed and len(row.row_hash) == 32
    assert out.count() == 2
    other = privacy.pseudonymize_open_orders(opened(values), products, customers, routes, SALT, AT)
    row = other.first()
    assert not SECRETS & set(row) and row.product_category == "Ring" and row.product_category_derived


def test_inventory_is_restored_and_replaced(values, products):
    stock = values("raw_sku product_description warehouse_code snapshot_date pallet_number",
                   ("1200002.0", "steel", "07", "20260710", "p"))
    row = privacy.pseudonymize_inventory(stock, products, SALT, AT).first()
    assert row.full_sku_code == "SKU-R-000001" and "raw_sku" not in row and row.warehouse_code != "07"


@pytest.mark.parametrize("position, value, message", [
    (6, "999999-99999", "Unmapped SKU"), (3, "other", "Unmapped customer"), (3, None, "Null customer identity"),
])
def test_a_bad_line_stops_the_job_that_writes_it(values, products, customers, position, value, message, tmp_path):
    bad = list(LINE)
    bad[position] = value
    out = privacy.pseudonymize_order_history(history(values, LINE, tuple(bad)), products, customers, SALT, AT)
    with pytest.raises(Exception, match=message):
        out.write.parquet(str(tmp_path / "x"))


def test_a_missing_route_is_unmapped(values, products, customers, routes, tmp_path):
    bad = list(LINE)
    bad[12] = None
    out = privacy.pseudonymize_open_orders(opened(values, tuple(bad)), products, customers, routes, SALT, AT)
    with pytest.raises(Exception, match="Unmapped route name"):
        out.write.parquet(str(tmp_path / "x"))


def test_a_doubled_mapping_key_stops_before_the_join(values, products, customers):
    with pytest.raises(GuardError, match="duplicate"):
        privacy.pseudonymize_order_history(history(values), products.unionAll(products), customers, SALT, AT)


def test_null_counts_as_not_pseudonymized(values):
    df = values("product_description product_category full_sku_code row_hash pseudonymized_at",
                (None, "c", "SKU-1", "h", "t"), ("Ring Product R-001", "c", None, None, "t"))
    assert {(r.column_name, r.problem, r.row_count) for r in privacy.violations(df, INVENTORY).collect()} == {
        ("product_description", "not_pseudonymized", 1), ("full_sku_code", "not_pseudonymized", 1), ("row_hash", "missing", 1),
    }


def test_unconfirmed_flags_count_false_and_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "original_sku_codes_removed boolean")
    assert df.agg(*privacy.unconfirmed_flags(df, ("original_sku_codes_removed",))).first()[0] == 2


GATE = list(dict.fromkeys((*ORDER_HISTORY.gate_required, *ORDER_HISTORY.gate_numeric, "batch_id")))


def batch(values, *changes, columns=GATE):
    good = dict.fromkeys(columns, "1") | {
        "customer_name": "Customer CUST-000001", "product_description": "Ring Product R-001", "batch_id": "b1",
    }
    rows = []
    for number, change in enumerate(changes):
        rows.append(tuple(({**good, "row_hash": f"h{number}", **change}).get(n) for n in columns))
    return values(" ".join(columns), *rows)


@pytest.mark.parametrize(
    "changes, status, failed, warned",
    [
        ([{}, {}], "passed", "", ""),
        ([{"row_hash": "h"}, {"row_hash": "h"}, {"row_hash": "h"}], "passed_with_warnings", "", "duplicate_row_hash"),
        ([{"order_amount": "-0.01"}, {"order_amount": "n/a"}], "passed_with_warnings", "", "negative_numeric_values"),
        ([{"customer_name": "Acme"}], "failed", "customer_pseudonymization", ""),
        ([{"product_description": None}], "failed", "critical_nulls,product_pseudonymization", ""),
        ([{"row_hash": None}, {"row_hash": None}], "failed", "critical_nulls,row_hash_completeness", "duplicate_row_hash"),
    ],
)
def test_gate_status(values, changes, status, failed, warned):
    result = quality.rollup(quality.gate(batch(values, *changes), ORDER_HISTORY)).first()
    assert (result.overall_status, result.failed_checks, result.warning_checks) == (status, failed, warned)
    assert result.row_count == len(changes)


def test_gate_runs_per_batch_and_counts_copies_beyond_the_first(values):
    df = batch(values, {"row_hash": "h"}, {"row_hash": "h"}, {"row_hash": "h", "batch_id": "b2"}, {"row_hash": None, "batch_id": "b2"})
    report = quality.gate(df, ORDER_HISTORY).where("check_name = 'duplicate_row_hash'")
    assert {(r.batch_id, r.value) for r in report.collect()} == {("b1", 1), ("b2", 0)}


def test_gate_with_missing_columns(values):
    columns = [n for n in GATE if n not in ("row_hash", "customer_name", "order_amount")]
    result = quality.rollup(quality.gate(batch(values, {}, columns=columns), ORDER_HISTORY)).first()
    assert result.failed_checks == "customer_pseudonymization,required_columns,row_hash_completeness"


def test_only_reports_of_the_same_batch_authorize(spark):
    batches = spark.createDataFrame([("d", "1", 5), ("d", "2", 5), ("d", "3", 0), ("e", "1", 5)], "dataset string, batch_id string, row_count long")
    statuses = spark.createDataFrame(
        [("d", "1", "passed", 5), ("d", "2", "passed_with_warnings", 4), ("d", "3", "passed", 0), ("e", "1", "failed", 5)],
        "dataset string, batch_id string, overall_status string, row_count long",
    )
    assert {r.batch_id for r in quality.authorized(batches, statuses).collect()} == {"1", "2", "3"}
    assert [tuple(r)[:2] for r in quality.publishable(batches, statuses).collect()] == [("d", "1")]


def test_specs_list_existing_columns():
    for spec in (ORDER_HISTORY, OPEN_ORDERS, INVENTORY):
        assert set(spec.privacy_flags) <= set(spec.published.names)
        assert len(set(spec.published.names)) == len(spec.published.names)
