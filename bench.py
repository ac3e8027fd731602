"""Bench: one full order-history batch and its parts; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.operators import privacy, publish, quality, standardize  # noqa: E402
from orderloom.plans import staging  # noqa: E402
from orderloom.plans.inputs import DEMO_SALT, RUN_AT, STANDARDIZED, Inputs  # noqa: E402
from orderloom.registry import queries  # noqa: E402
from orderloom.session import local_session, materialize, remove_scratch, scratch_path  # noqa: E402
from orderloom.sources import readers  # noqa: E402
from orderloom.sources import table_extracts as extracts  # noqa: E402
from orderloom.spec import ORDER_HISTORY, ORDER_HISTORY_HEADERS  # noqa: E402

HEADLINE = (
    "standardize_order_history", "customer_base", "map_customers", "map_skus", "duplicate_rows", "order_history_grain",
    "order_history_repeated_rows", "publish_partition_replace", "stg_order_history", "open_orders_dates_standardized",
    "pseudonymize_inventory",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def track(spark, sf_dir: str) -> dict[str, float]:
    """The order-history track, every stage written as the real job writes it."""
    seconds: dict[str, float] = {}
    inputs = Inputs(spark, sf_dir)
    # The delivered extract exists before the track starts.
    delivered = materialize(
        extracts.coded(inputs.history(*extracts.ORDER_HISTORY_COLUMNS), ORDER_HISTORY_HEADERS), "delivered"
    )

    def timed(name: str, step):
        started = time.time()
        result = step()
        seconds[name] = round(time.time() - started, 3)
        return result

    standard = timed(
        "track_standardize",
        lambda: materialize(standardize.checked_standardize(delivered, ORDER_HISTORY, STANDARDIZED), "standardized"),
    )
    products, customers = timed("track_mappings", lambda: (inputs.products(), inputs.customers()))
    batch = timed(
        "track_pseudonymize",
        lambda: materialize(
            privacy.pseudonymize_order_history(standard, products, customers, DEMO_SALT, RUN_AT), "pseudonymized"
        ),
    )
    statuses = timed("track_quality_gate", lambda: quality.rollup(quality.gate(batch, ORDER_HISTORY)).collect())
    rows = sum(row.row_count for row in statuses)

    def publication():
        landed = readers.with_file_lineage(batch.withColumn("source_file_row_number", readers.parquet_row_number()))
        typed = readers.align_to_schema(publish.ready_dates(landed), ORDER_HISTORY.published)
        table = publish.CommittedTable(
            spark, scratch_path(spark, "bench"), "order_history", ORDER_HISTORY.published
        )
        table.replace(typed, "order_history_pseudonymized_20260915_032626", rows, ORDER_HISTORY, batch)
        return table.read()

    published = timed("track_publish", publication)
    timed("track_staging_view", lambda: run(staging.stg_order_history(published)))
    seconds["whole_track"] = round(sum(seconds.values()), 3)
    seconds["track_rows"] = rows
    return seconds


def peak_memory_mb(spark) -> int | None:
    """The largest resident size so far of the JVM that runs everything in local mode."""
    pid = spark.sparkContext._gateway.proc.pid
    try:
        with open(f"/proc/{pid}/status") as status:
            return next(int(line.split()[1]) // 1024 for line in status if line.startswith("VmHWM"))
    except (OSError, StopIteration):
        return None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "16g"), int(cpus) if cpus.isdigit() else 8)
    run(extracts.table(spark, sf_dir, "lineitem"))  # start the executors before the clock
    seconds = track(spark, sf_dir)
    rows = seconds.pop("track_rows")
    for name in HEADLINE:
        started = time.time()
        run(queries()[name](spark, sf_dir))
        seconds[name] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "order_history_whole_track",
                "value": seconds["whole_track"],
                "unit": "sec",
                "rows": rows,
                "rows_per_sec": round(rows / seconds["whole_track"]),
                "cpus": cpus,
                "peak_memory_mb": peak_memory_mb(spark),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "queries": seconds,
            }
        )
    )
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
