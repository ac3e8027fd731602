"""File intake: every arriving file once, each gated and published as its own partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators import quality, reports
from orderloom.operators.numbering import equal_keys
from orderloom.operators.publish import CommittedTable
from orderloom.session import held, materialize
from orderloom.spec import DatasetSpec

#: Holds the text of a delimited line that does not fit the schema.
BROKEN = "_broken_line"


def run_file_intake(
    spark: SparkSession,
    landing: str,
    fmt: str,
    schema: T.StructType,
    checkpoint: str,
    table: CommittedTable,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    publication: str = "source_filename",
    files_per_batch: int | None = None,
    gate: DatasetSpec | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop.

    The checkpoint remembers files already taken. A batch that fails is replayed, which is
    safe because publishing replaces whole publications. All files of a batch are published
    together, with one write and one commit. Batches run one after another, so
    each dataset keeps its single writer.

    With ``gate`` every file passes that dataset's quality gate by itself. Files that fail it, or
    hold lines that do not fit the schema, leave their rows and report under ``quarantine`` and
    stop neither the other files nor the stream; without ``gate`` a broken line fails the batch.
    """
    if gate is not None and quarantine is None:
        raise ValueError("A gated intake needs a quarantine folder.")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
        if gate is not None:
            wider = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
            reader = reader.schema(wider).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    arrived = reader.format(fmt).load(landing)

    def publish(batch: DataFrame, batch_number: int) -> None:
        if batch.isEmpty():
            return
        rows = transform(batch)
        if gate is None:
            table.replace_all(rows, publication)
            return
        with held(rows, "arrived") as arrived:
            passed = _passed(arrived, gate, publication, quarantine, batch_number)
            if not passed.isEmpty():
                table.replace_all(passed, publication)

    query = (
        arrived.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _passed(rows: DataFrame, spec: DatasetSpec, publication: str, quarantine: str, batch_number: int) -> DataFrame:
    """The rows of files that pass; the others' rows and all reports are written first.

    One gate over the whole batch, grouped by file. A replayed batch overwrites its own quarantine.
    """
    report = quality.gate(rows, spec, publication)
    if BROKEN in rows.columns:
        broken = F.count_if(F.col(BROKEN).isNotNull())
        lines = rows.groupBy(F.col(publication).alias("batch_id")).agg(broken.alias("value")).select(
            F.lit(spec.name).alias("dataset"), "batch_id", F.lit("readable_lines").alias("check_name"),
            F.when(F.col("value") > 0, quality.FAILED).otherwise(quality.PASSED).alias("status"),
            F.lit("broken_lines").alias("metric"), "value",
        )
        report = report.unionByName(lines)
    report = materialize(report, "report")
    reports.save(reports.documents(report), f"{quarantine}/reports")
    verdict = quality.rollup(report).select(F.col("batch_id").alias("_file"), "overall_status")
    judged = rows.join(verdict, equal_keys({publication: "_file"})).drop("_file")
    loadable = F.col("overall_status").isin(*quality.LOADABLE)
    refused = judged.where(~loadable).drop("overall_status")
    refused.write.mode("overwrite").option("compression", "zstd").parquet(f"{quarantine}/rows/batch={batch_number}")
    return judged.where(loadable).drop("overall_status", BROKEN)


def quarantined(spark: SparkSession, quarantine: str) -> tuple[DataFrame, DataFrame]:
    """The rows of refused files with the ``batch`` that brought them, and the newest report of every file."""
    return spark.read.parquet(f"{quarantine}/rows"), reports.read(spark, f"{quarantine}/reports")
