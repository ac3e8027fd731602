"""Reading the given tables and passing batches of rows to Python tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_rows(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int = 2000,
    after: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Apply ``function`` to the columns of at most ``rows`` rows at a time.

    Columns arrive and leave as Python lists, so one call holds a bounded piece of a partition
    whatever the partition's size. Arrow's own limit on bytes per batch holds as well. ``after``
    is called once a partition is done, to let go of what the process remembers.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                piece = batch.slice(start, rows)
                out = function({n: piece.column(k).to_pylist() for k, n in enumerate(piece.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) for f in arrow_schema], schema=arrow_schema
                )
        after()

    return df.mapInArrow(run, schema)


def shared(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Send a value of bounded size to every executor once; call the result to read it there."""
    sent = spark.sparkContext.broadcast(value)
    return lambda: sent.value
