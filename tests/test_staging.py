import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.operators.guards import GuardError
from orderloom.plans import staging
from orderloom.sources.readers import with_missing_columns
from orderloom.spec import PUBLISHED_OPEN_ORDERS, PUBLISHED_ORDER_HISTORY


@pytest.fixture
def opened(spark):
    rows = spark.createDataFrame(
        [("c", "1", "u", "f", 1, 20260228, 0, 20260230, None, 3), ("c", "1", "u", "f", 2, 20260228, 20260301, 0, 0, 4)],
        "company_code string, order_number string, unique_sku_code string, source_filename string, "
        "source_file_row_number bigint, order_date bigint, scheduled_ship_date bigint, customer_requested_date bigint, "
        "revised_delivery_date bigint, final_order_quantity bigint",
    )
    return with_missing_columns(rows, PUBLISHED_OPEN_ORDERS)


def test_zero_and_impossible_dates(opened):
    view = staging.stg_open_orders(opened)
    first = view.orderBy("source_file_row_number").first()
    assert (first.order_date, first.scheduled_ship_date, first.customer_requested_date) == (dt.date(2026, 2, 28), None, None)
    assert "order_amount" not in view.columns and "loaded_at" in view.columns
    # only the impossible date of the first record is a violation, zeros are not
    assert [r.source_file_row_number for r in staging.dates_not_standardized(opened, view).collect()] == [1]
    missing = staging.dates_not_standardized(opened, view.where("source_file_row_number = 1"))
    assert sorted(r.source_file_row_number for r in missing.collect()) == [1, 2]


def test_data_tests_find_their_defects(opened):
    view = staging.stg_open_orders(opened)
    assert staging.repeated_combinations(view, staging.BUSINESS_KEY, "n").first().n == 2
    assert staging.row_count_difference(opened, view).count() == 0
    assert tuple(staging.row_count_difference(opened, view.limit(1)).first()) == (2, 1)
    assert staging.measures_changed(opened, view).count() == 0
    changed = view.withColumn("final_order_quantity", F.when(F.col("source_file_row_number") == 1, F.lit(None)).otherwise(F.col("final_order_quantity")))
    assert staging.measures_changed(opened, changed).count() == 1
    with pytest.raises(GuardError, match="grain"):
        staging.assert_empty(staging.repeated_combinations(view, staging.BUSINESS_KEY, "n"), "grain")
    nulls = staging.not_null_failures(view.withColumn("company_code", F.lit(None)), ["company_code", "order_number"], "m")
    assert [tuple(r) for r in nulls.collect()] == [("m", "company_code", 2)]


def test_source_identity_ignores_pairs_with_a_null(spark):
    rows = spark.createDataFrame([("f", 1), ("f", None), (None, 1), ("f", 1)], "source_filename string, source_file_row_number bigint")
    assert tuple(staging.source_identity(rows).first()) == (4, 1, 1, 1)
    counts = staging.candidate_key_counts(rows, staging.SOURCE_POSITION, "x").first()
    assert (counts.total_rows, counts.distinct_candidate_keys) == (4, 3)


def test_empty_tables_count_as_zero(spark):
    empty = spark.createDataFrame([], PUBLISHED_ORDER_HISTORY)
    assert staging.row_count_difference(empty, staging.stg_order_history(empty)).count() == 0
    assert staging.order_history_grain(empty).count() == 0
