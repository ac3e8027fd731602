"""What rows cost: extracts are scanned once, checks read their rows once, and scratch goes when it is done."""

import os

import pytest
from pyspark.sql import functions as F

from orderloom import registry, session
from orderloom.operators import privacy, quality
from orderloom.plans import inputs
from orderloom.sources import table_extracts as extracts
from orderloom.spec import ORDER_HISTORY


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def sf_dir(spark, tmp_path):
    tables = {
        "lineitem": "select id l_orderkey, id % 3 l_partkey, 1L l_suppkey, 1 l_linenumber, 5D l_quantity, 7D l_extendedprice, "
        "if(id = 0, 0D, 0.1D) l_discount, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus, timestamp'1996-01-01' l_shipdate from range(4)",
        "orders": "select id o_orderkey, id % 2 o_custkey, 'O' o_orderstatus, timestamp'1995-01-01' o_orderdate, '5-LOW' o_orderpriority from range(3)",
        "customer": "select id c_custkey, concat('C', id) c_name, 0 c_nationkey from range(1)",
        "nation": "select 0 n_nationkey, 'X' n_name",
        "part": "select id p_partkey, 'a b' p_name, 'Brand#1' p_brand, 'T' p_type, 2 p_size from range(3)",
        "supplier": "select 1L s_suppkey, 0 s_nationkey",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_an_extract_scans_lines_once_and_joins_customers_to_orders(spark, sf_dir):
    rows = extracts.order_history(spark, sf_dir, ("order_number", "customer_name", "full_sku_code", "source_filename"))
    assert plan(rows).count("Relation [l_orderkey#") == 1 and plan(rows).count("Union") == 0
    found = sorted((r.order_number or "", r.customer_name or "", extracts.CORRECTION_RUN in r.source_filename) for r in rows.collect())
    # Line 0 was exported twice, order 1 has no customer row, line 3 no order.
    assert found == [("", "", False), ("0", " C0\t", False), ("0", " C0\t", True), ("1", "", False), ("2", " C0\t", False)]


def test_checks_read_their_rows_once(spark):
    names = dict.fromkeys([*ORDER_HISTORY.validator_required, *ORDER_HISTORY.gate_required, "batch_id", "row_hash"])
    rows = spark.range(6).select(*(F.lit("real").alias(n) for n in names if n not in ("row_hash", "batch_id")), (F.col("id") % 2).cast("string").alias("batch_id"),
                                 F.when(F.col("id") > 1, F.lit("h")).alias("row_hash"))
    found = privacy.violations(rows, ORDER_HISTORY)
    report = quality.gate(rows, ORDER_HISTORY)
    assert plan(found).count("Range (") == 1 and plan(report).count("Range (") == 1
    counts = {(r.column_name, r.problem): r.row_count for r in found.collect()}
    assert counts[("row_hash", "missing")] == 2 and counts[("row_hash", "duplicate")] == 4
    metrics = {(r.batch_id, r.metric): r.value for r in report.collect()}
    assert [metrics[(b, "duplicate_row_hash_count")] for b in "01"] == [1, 1]
    assert [metrics[(b, "missing_row_hash")] for b in "01"] == [1, 1] and metrics[("0", "row_count")] == 3
    assert privacy.violations(rows.limit(0), ORDER_HISTORY).count() == quality.gate(rows.limit(0), ORDER_HISTORY).count() == 0


def test_held_tables_go_with_their_block(spark):
    def folders():
        root = session._scratch_root(spark)
        return [n for n in (os.listdir(root) if os.path.isdir(root) else []) if n.startswith("passing-")]

    with pytest.raises(KeyError), session.held(spark.range(3), "passing") as rows:
        assert rows.count() == 3 and len(folders()) == 1
        raise KeyError
    assert not folders()


def test_gates_store_no_batch_and_batches_share_their_product_mapping(spark, monkeypatch):
    stored, built = [], []
    monkeypatch.setattr(registry, "materialize", lambda df, label: stored.append(label) or df)
    rows = spark.range(4).select(F.lit("b").alias("batch_id"), F.lit("s").alias("snapshot_date"), F.lit("h").alias("row_hash"))
    for name in ("pseudonymized_history", "pseudonymized_open_orders", "pseudonymized_inventory", "raw_open_orders"):
        monkeypatch.setattr(inputs.Inputs, name, lambda self: rows)
    queries = registry.queries()
    for name in ("order_history", "open_orders", "inventory"):
        report = {r.metric: r.value for r in queries[f"quality_gate_{name}"](spark, "").collect()}
        assert report["row_count"] == 4 and report["duplicate_row_hash_count"] == 3
    assert sorted(r.dataset for r in queries["gate_status"](spark, "").collect()) == ["inventory", "open_orders", "order_history"]
    assert not stored

    for name in ("stored_product_profile", "prior_products", "categories"):
        monkeypatch.setattr(inputs.Inputs, name, lambda self: None)
    monkeypatch.setattr(inputs.identities, "build_product_mapping", lambda *_: built.append(1) or rows)
    monkeypatch.setattr(inputs, "materialize", lambda df, label: df)
    i = inputs.Inputs(spark, "")
    assert i.products() is i.products() and len(built) == 1


def test_orders_come_before_parts_where_only_their_date_is_asked_for(spark, sf_dir):
    """Lines outside the wanted time are gone before parts add their text; parts came first before."""
    columns = ("full_sku_code", "product_description", "order_date")
    rows = extracts.order_history(spark, sf_dir, columns).where(F.col("order_date") < "19950102")
    text = plan(rows)
    assert text.index("Relation [l_orderkey#") < text.index("Relation [o_orderkey#") < text.index("Relation [p_partkey#")
    # Line 3 has no order, so no date.
    found = sorted(tuple(r) for r in rows.collect())
    assert found == [(f"010000-{k:05d}", f"a b {k}", "19950101") for k in (0, 0, 1, 2)]
    wide = plan(extracts.order_history(spark, sf_dir, (*columns, "order_status")))
    assert wide.index("Relation [p_partkey#") < wide.index("Relation [o_orderkey#")


def test_repeated_fingerprints_are_grouped_by_their_bytes(spark):
    """They were grouped as text of twice the size; text that is no fingerprint stays apart from all others."""
    digest = "0123456789abcdef" * 2
    hashes = [digest, digest, digest.upper(), digest + "\n", digest[:-1], digest[2:], "", "", None, None, None]
    names = [n for n in dict.fromkeys(ORDER_HISTORY.validator_required) if n != "row_hash"]
    rows = spark.createDataFrame([(h,) for h in hashes], "row_hash string").select("row_hash", *(F.lit("real").alias(n) for n in names))
    found = privacy.violations(rows, ORDER_HISTORY)
    assert "unhex(" in plan(found)
    counts = {(r.column_name, r.problem): r.row_count for r in found.collect()}
    assert counts[("row_hash", "missing")] == 3 and counts[("row_hash", "duplicate")] == 4
