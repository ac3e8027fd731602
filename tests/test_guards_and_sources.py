from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators import guards, standardize
from orderloom.operators.guards import GuardError
from orderloom.sources import readers
from orderloom.spec import INVENTORY, OPEN_ORDERS, ORDER_HISTORY

AT = datetime(2026, 1, 1)


def raw(values, spec, drop=(), extra=()):
    names = [n for n in (*spec.headers, *spec.tags, *spec.drops) if n not in drop] + list(extra)
    df = values("a", ("1",))
    return df.select(*(F.lit(str(k)).alias(n) for k, n in enumerate(names)))


@pytest.mark.parametrize("spec", [ORDER_HISTORY, OPEN_ORDERS, INVENTORY], ids=lambda s: s.name)
def test_standardize_renames_every_header(values, spec):
    out = standardize.standardize(raw(values, spec), spec, AT)
    assert set(out.columns) == {*spec.headers.values(), *spec.tags, "standardized_at"}


def test_unknown_header_fails_missing_header_is_reported(values):
    with pytest.raises(GuardError, match="promo"):
        standardize.standardize(raw(values, ORDER_HISTORY, extra=["promo"]), ORDER_HISTORY, AT)
    report = standardize.drift_report(raw(values, ORDER_HISTORY, drop=["ord_amt"], extra=["promo"]), ORDER_HISTORY)
    assert {tuple(r) for r in report.collect()} == {
        ("unknown", "promo", "failed", 1), ("missing", "ord_amt", "warning", 0),
    }
    assert standardize.drift_report(raw(values, INVENTORY, drop=["wgt"]), INVENTORY).count() == 0


def test_renaming_onto_an_existing_name_fails(values):
    with pytest.raises(GuardError, match="duplicate"):
        standardize.standardize(
            raw(values, ORDER_HISTORY, extra=["company_code"]),
            ORDER_HISTORY.with_headers({**ORDER_HISTORY.headers, "company_code": "company_code"}), AT,
        )


def test_header_cleaning_levels(values):
    assert guards.clean_header(" Ord/No A-b ", "trim") == "ord/no a-b"
    assert guards.clean_header(" Ord/No A-b ", "spaces") == "ord/no_a-b"
    assert guards.clean_header(" Ord/No A-b ", "symbols") == "ord_no_a_b"
    with pytest.raises(GuardError, match="duplicate"):
        guards.clean_headers(values("a b", ("1", "2")).toDF("A b", "a_B"))


def test_empty_input_and_missing_columns(values):
    empty = values("a", ("1",)).where("false")
    with pytest.raises(GuardError, match="0 rows"):
        guards.require_rows(empty, "x")
    with pytest.raises(GuardError, match="missing"):
        guards.require_columns(empty, ["b"], "x")


def test_warehouse_code_is_required(values):
    with pytest.raises(GuardError):
        standardize.tag_snapshot(values("sku", ("1",)), " ", "20260101")


def test_duplicate_and_unmapped_keys(values):
    mapping = values("k v", ("a", "1"), ("a", "2"), ("b", "3"))
    with pytest.raises(GuardError, match="'a'"):
        guards.require_unique(mapping, "k", "mapping")
    with pytest.raises(GuardError, match="c"):
        guards.require_mapped(values("k", ("a",), ("c",)), mapping, "k", "key")


def test_align_by_name_any_case(values):
    df = values("B A extra", ("1", "x", "e"))
    out = readers.align_to_schema(df, T.StructType.fromDDL("a string, b bigint, c date"))
    assert [tuple(r) for r in out.collect()] == [("x", 1, None)]
    with pytest.raises(GuardError, match="case"):
        readers.align_to_schema(values("x Y", ("1", "2")).toDF("a", "A"), T.StructType.fromDDL("a string"))


def test_csv_keeps_zeros_and_bom_and_numbers_rows_per_file(spark, tmp_path):
    for name, rows in (("one", 900), ("two", 300)):
        lines = "\n".join(f"{k:06d},x" for k in range(1, rows + 1))
        (tmp_path / f"{name}.csv").write_text("﻿code,v\n" + lines + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = readers.read_extract(spark, str(tmp_path))
        assert df.columns == ["code", "v"]
        assert df.rdd.getNumPartitions() > 3
        placed = readers.number_csv_rows(df)
        wrong = placed.where(F.col("code").cast("bigint") != F.col("source_file_row_number"))
        assert placed.count() == 1200
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_malformed_csv_row_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        readers.read_extract(spark, str(tmp_path)).collect()


def test_files_listing_hash_and_guard(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("x\n2\n")
    files = readers.file_hashes(spark, str(tmp_path))
    assert files.select("source_file_hash").distinct().count() == 2
    manifest = files.where(F.col("source_file").endswith("a.csv"))
    fresh = readers.new_files_only(files, manifest).collect()
    assert [r.source_file[-5:] for r in fresh] == ["b.csv"]
    assert readers.new_files_only(files, manifest, force=True).count() == 2
    assert readers.list_files(spark, str(tmp_path)).count() == 2


def test_a_file_digest_tells_order_line_ends_and_length_apart(spark, tmp_path):
    texts = ["1,2\n2,1\n", "2,1\n1,2\n", "1,2\r\n2,1\r\n", "1,2\n2,1", "\n", "1,2\n2,1\n\n"]
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.csv").write_bytes(text.encode())
    (tmp_path / "same.csv").write_bytes(texts[0].encode())
    found = {r.source_file[-5:]: r.source_file_hash for r in readers.file_hashes(spark, str(tmp_path)).collect()}
    assert len(found) == len(texts) + 1 and len(set(found.values())) == len(texts)
    assert found["e.csv"] == found["0.csv"]


def test_newest_file_passes_over_lock_files(spark):
    files = spark.createDataFrame([("/x/a.csv", 1), ("/x/b.csv", 3), ("/x/~$c.csv", 9)], "path string, modificationTime long")
    assert readers.newest_file(files).first().path == "/x/b.csv"


def test_ids_in_file_names(values):
    df = values("n", ("order_20260101_101500.csv",), ("order_20260230_101500.csv",), ("x.csv",))
    assert [r[0] for r in df.select(readers.run_id(F.col("n"))).collect()] == ["20260101_101500", None, None]
    assert [r[0] for r in df.select(readers.snapshot_id(F.col("n"))).collect()] == ["20260101", None, None]


def test_catalog_and_discovery(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,x\n")
    found = [(r.column_position, r.column_name, r.data_type) for r in readers.discover_schema(spark, str(tmp_path)).collect()]
    assert found == [(1, "n", "int"), (2, "t", "string")]


def test_missing_lineage_columns_are_added(values):
    out = readers.with_missing_columns(values("a", ("1",)), T.StructType.fromDDL("a string, n bigint"))
    assert out.columns == ["a", "n"] and out.first().n is None
