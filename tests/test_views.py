"""Views by name: order, refusals, and data tests that fail where they should."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.guards import GuardError
from orderloom.plans import staging, views
from orderloom.plans.views import Catalog, View
from orderloom.sources import table_extracts as extracts

SF_DIR = "/root/testdata/sf0.001"
NUMBERS = {"raw_numbers": T.StructType().add("n", "long")}


def doubled(df):
    return df.select((F.col("n") * 2).alias("n"))


def test_views_are_registered_after_what_they_use(spark):
    chain = {"four": View(("two", "raw_numbers"), lambda a, b: a.unionByName(b)), "two": View(("raw_numbers",), doubled)}
    catalog = Catalog(spark, {"raw_numbers": spark.range(3).toDF("n")}, "t1_", NUMBERS, chain, {})
    assert catalog.register(["four"]) == ["t1_raw_numbers", "t1_two", "t1_four"]
    assert sorted(r.n for r in spark.sql("select n from t1_four where n > 0").collect()) == [1, 2, 2, 4]
    # a table of the catalog serves as a source as well
    again = Catalog(spark, {"raw_numbers": "t1_two"}, "t2_", NUMBERS, chain, {})
    assert sorted(r.n for r in again.view("two").collect()) == [0, 4, 8]
    assert {tuple(r) for r in catalog.lineage().collect()} == {("four", "two"), ("four", "raw_numbers"), ("two", "raw_numbers")}
    catalog.drop()
    again.drop()
    assert not spark.catalog.tableExists("t1_four")


def test_refusals(spark):
    numbers = spark.range(3).toDF("n")
    loop = {"a": View(("b",), doubled), "b": View(("a",), doubled)}
    with pytest.raises(GuardError, match="a > b > a"):
        Catalog(spark, {"raw_numbers": numbers}, "t3_", NUMBERS, loop, {}).view("a")
    with pytest.raises(GuardError, match="not given"):
        Catalog(spark, {}, "t3_", NUMBERS, {}, {}).view("raw_numbers")
    with pytest.raises(GuardError, match="Undeclared"):
        Catalog(spark, {"other": numbers}, "t3_", NUMBERS, {}, {})
    with pytest.raises(GuardError, match="missing required"):
        Catalog(spark, {"raw_numbers": numbers.toDF("m")}, "t3_", NUMBERS, {}, {}).view("raw_numbers")
    with pytest.raises(GuardError, match="is called"):
        Catalog(spark, {}, "t3_", NUMBERS, {}, {}).view("nothing")
    assert Catalog(spark, {}, "t3_").register() == [] and Catalog(spark, {}, "t3_").run_tests().count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_staging_views_and_their_tests(spark):
    raw = extracts.published_open_orders(spark, SF_DIR)
    good = Catalog(spark, {"raw_open_orders": raw}, "t4_")
    assert good.register() == ["t4_raw_open_orders", "t4_stg_open_orders"]
    assert spark.sql("select * from t4_stg_open_orders").count() == raw.count()
    clean = {r.test: r.failing_rows for r in good.run_tests().collect()}
    assert set(clean) == {n for n in views.TESTS if n.startswith("open_orders")}
    # these tables do repeat candidate keys, and break no other rule
    keys = ", ".join(staging.BUSINESS_KEY)
    repeats = spark.sql(f"select {keys} from t4_stg_open_orders group by {keys} having count(*) > 1").count()
    assert {n: c for n, c in clean.items() if c} == {"open_orders_candidate_key_unique": repeats}
    first = raw.limit(1)
    bad = Catalog(spark, {"raw_open_orders": raw.unionByName(first)}, "t5_")
    found = {r.test: r.failing_rows for r in bad.run_tests(["open_orders_source_position_unique", "open_orders_row_count_preserved"]).collect()}
    assert found == {"open_orders_source_position_unique": 1, "open_orders_row_count_preserved": 0}
    good.drop()
    bad.drop()
