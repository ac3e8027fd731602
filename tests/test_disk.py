"""What lies on disk at a time: shuffle files go once a table is stored, copies with the next one, rows that repeat move alone."""

import os
import time

import pytest
from pyspark.sql import functions as F

from orderloom import registry, session
from orderloom.functions.hashing import customer_key
from orderloom.operators import privacy, quality
from orderloom.operators.publish import CommittedTable
from orderloom.operators.repeats import repeated_rows
from orderloom.plans import inputs
from orderloom.sources import readers
from orderloom.spec import ORDER_HISTORY
from orderloom.streaming.intake import run_file_intake
from tests.test_privacy_and_quality import AT, GATE, LINE, SALT, customers, history, opened, products, routes  # noqa: F401


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    roots = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {n for root in roots for _, _, names in os.walk(root) for n in names if n.startswith("shuffle_")}


def folders(spark, label):
    root = session._scratch_root(spark)
    return [n for n in (os.listdir(root) if os.path.isdir(root) else []) if n.startswith(f"{label}-")]


def test_shuffle_files_go_once_a_table_is_stored(spark):
    before = shuffle_files(spark)
    stored = session.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(100):  # the driver's cleaner works beside the job
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
        session._release(spark)  # as the next store does
    assert not shuffle_files(spark) - before and stored.count() == 7


def test_a_relay_works_in_pieces_and_keeps_one_copy(spark, monkeypatch):
    monkeypatch.setattr(session, "PIECE_BYTES", 1)
    seen = []

    def work(part):
        seen.append(part.count())
        return part.withColumn("twice", F.col("id") * 2)

    with session.Relay("relayed") as step:
        rows = step(spark.range(0, 100, numPartitions=5))
        rows = step(rows, work)
        assert len(seen) == 5 and sum(seen) == 100 and len(folders(spark, "relayed")) == 1
        assert sorted(map(tuple, rows.collect())) == [(k, 2 * k) for k in range(100)]
        empty = step(rows.where("id < 0"), lambda part: part.drop("id"))
        assert empty.columns == ["twice"] and empty.count() == 0
        with pytest.raises(Exception, match="bad row"):
            step(spark.range(2), lambda part: part.select(F.when(F.col("id") == 1, F.raise_error(F.lit("bad row"))).alias("x")))
    assert not folders(spark, "relayed")


def test_stored_lookups_give_the_rows_of_one_plan(spark, values, products, customers, routes, monkeypatch):  # noqa: F811
    monkeypatch.setattr(session, "PIECE_BYTES", 1)
    lines = [LINE, LINE, (*LINE[:4], None, *LINE[5:])]
    for build, rows, *mappings in (
        (privacy.pseudonymize_order_history, history(values, *lines).repartition(3), products, customers),
        (privacy.pseudonymize_open_orders, opened(values, *lines).repartition(3), products, customers, routes),
    ):
        planned = build(rows, *mappings, SALT, AT)
        with session.Relay("lookups") as step:
            stored = build(rows, *mappings, SALT, AT, step)
            assert stored.columns == planned.columns and len(folders(spark, "lookups")) == 1
            assert sorted(map(str, stored.collect())) == sorted(map(str, planned.collect()))
    bad = history(values, LINE, (*LINE[:3], "other", *LINE[4:]))
    with session.Relay("lookups") as step, pytest.raises(Exception, match="Unmapped customer"):
        privacy.pseudonymize_order_history(bad, products, customers, SALT, AT, step)
    assert not folders(spark, "lookups")


def test_customers_are_joined_by_the_bytes_of_their_key(spark, values):
    facts = values("source_customer_code ship_to_customer_code customer_name", ("7", "1", " acme "), ("8", "1", "b"), ("9", "1", "c"))
    key = lambda code, name: customer_key(F.lit(code), F.lit("1"), F.lit(name))
    pairs = (
        (key("7", "ACME"), "A"), (F.upper(key("8", "B")), "B"), (F.concat(key("9", "C"), F.lit("\n")), "C"), (F.lit(None).cast("string"), "D"), (F.lit("x"), "E"),
    )
    entry = lambda k, name: F.struct(k.alias("customer_hash_key"), F.lit(name).alias("pseudo_customer_name"))
    mapping = spark.range(1).select(F.inline(F.array(*(entry(*pair) for pair in pairs))))
    found = privacy.lookup_customers(facts, mapping)
    assert "unhex(" in plan(found)
    assert found.columns == ["customer_hash_key", *facts.columns, "pseudo_customer_name"]
    # Text of another case or length is another key.
    assert {(r.source_customer_code, r.pseudo_customer_name) for r in found.collect()} == {("7", "A"), ("8", None), ("9", None)}
    assert all(len(r.customer_hash_key) == 32 and r.customer_hash_key == r.customer_hash_key.lower() for r in found.collect())


def test_gates_group_fingerprints_by_their_bytes(spark):
    digest = "0123456789abcdef" * 2
    hashes = [digest, digest, digest.upper(), digest + "\n", digest[:-1], "", "", None, None]
    names = [n for n in GATE if n not in ("row_hash", "batch_id")]
    rows = spark.createDataFrame([(h, "b") for h in hashes], "row_hash string, batch_id string").select(
        "*", *(F.lit("1").alias(n) for n in names)
    )
    report = quality.gate(rows, ORDER_HISTORY)
    assert "unhex(" in plan(report)
    found = {r.metric: r.value for r in report.collect()}
    assert found["row_count"] == 9 and found["missing_row_hash"] == 2 and found["duplicate_row_hash_count"] == 3


@pytest.mark.parametrize("bits", [2**26, 2**16, 1])
def test_only_rows_of_repeated_keys_reach_the_join(spark, monkeypatch, bits):
    monkeypatch.setattr("orderloom.operators.repeats.FILTER_BITS", bits)
    ids = F.col("id")
    rows = spark.range(3000).select(
        F.when(ids % 10 != 0, F.when(ids < 20, F.lit("hot")).otherwise(ids.cast("string"))).alias("k"),
        F.when(ids % 3 != 0, F.to_date(F.lit("2026-01-01"))).alias("d"), "id",
    )
    found = repeated_rows(rows, ["k", "d"], "n")
    assert "getbit(" in plan(found)
    expected = {}
    for r in rows.collect():
        expected.setdefault((r.k, r.d), []).append(r.id)
    wanted = sorted((i, len(group)) for group in expected.values() if len(group) > 1 for i in group)
    assert sorted((r.id, r.n) for r in found.collect()) == wanted and len(wanted) == 318


def test_lines_do_not_move_to_be_numbered(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(0, 50, numPartitions=3).write.csv(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = readers.number_csv_rows(spark.read.schema("id long").csv(path))
        assert "BroadcastHashJoin" in placed._jdf.queryExecution().sparkPlan().toString()
        assert sum(r.source_file_row_number for r in placed.collect()) == sum(sum(range(1, n + 1)) for n in (16, 17, 17))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_intake_drops_its_copy_of_what_arrived(spark, tmp_path):
    from dataclasses import replace

    spec = replace(ORDER_HISTORY, gate_patterns=(), gate_required=("order_number",), gate_critical=("order_number",))
    rows = spark.range(4).selectExpr("cast(id as string) order_number", "cast(id as string) row_hash", "'b' batch_id", "concat('f', id % 2) source_filename")
    rows.write.option("header", True).option("compression", "gzip").csv(str(tmp_path / "landing"))
    table = CommittedTable(spark, str(tmp_path), "order_history", rows.schema)
    held = str(tmp_path / "held")
    run_file_intake(spark, str(tmp_path / "landing"), "csv", rows.schema, str(tmp_path / "c"), table, gate=spec, quarantine=held)
    assert table.read().count() == 4 and not folders(spark, "arrived")


def test_datasets_are_checked_one_after_another(spark, monkeypatch):
    """The next batch is not built before the last one's report is stored."""
    events = []
    rows = spark.range(4).select(F.lit("b").alias("batch_id"), F.lit("s").alias("snapshot_date"), F.lit("h").alias("row_hash"))
    names = ("pseudonymized_history", "pseudonymized_inventory", "raw_history", "raw_open_orders", "raw_inventory")
    for name in names:
        monkeypatch.setattr(inputs.Inputs, name, lambda self, name=name: events.append(name) or rows)
    stored = lambda df, label: events.append(label) or session.materialize(df, label)
    monkeypatch.setattr(quality, "materialize", stored)
    monkeypatch.setattr(inputs.Inputs, "drop_copies", lambda self: events.append("dropped"))
    queries = registry.queries()
    assert queries["gate_status"](spark, "").count() == 3
    assert events == ["pseudonymized_history", "report", "dropped", "raw_open_orders", "report", "pseudonymized_inventory", "report", "dropped"]
    events.clear()
    assert queries["authorized_batches"](spark, "").count() == 0 == queries["publishable_batches"](spark, "").count()
    assert events[:5] == ["pseudonymized_history", "report", "dropped", "raw_open_orders", "report"]
    events.clear()
    monkeypatch.setattr(registry, "materialize", stored)
    monkeypatch.setattr(privacy, "violations", lambda df, spec: df.select(F.lit(spec.name).alias("dataset")).distinct())
    assert queries["privacy_violations"](spark, "").count() == 3
    assert events == ["raw_history", "found", "raw_open_orders", "found", "raw_inventory", "found"]
