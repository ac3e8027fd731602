"""Scans: delimited extracts as text, lineage columns, mappings, listings and file guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.text import empty_to_null, null_if_token
from orderloom.operators.guards import GuardError, clean_headers, require_columns, require_rows

# Shapes of the ids in file names.
RUN_ID = r"(\d{8}_\d{6})"
SNAPSHOT_ID = r"(\d{8})"
INGESTION_ID = r"^\d{8}_\d{6}(_\d{6})?$"


def read_extract(spark: SparkSession, path: str | list[str], fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """A raw extract as text only: inference would eat leading zeros. Bad rows fail the job."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    return (
        spark.read.option("header", True).option("mode", "FAILFAST").option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
        .option("escape", '"').csv(path)
    )


def apply_null_tokens(df: DataFrame) -> DataFrame:
    """Spark's reader takes one null token; the text format has three, after trimming."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: null_if_token(F.col(f"`{name}`")) for name in text})


def with_file_lineage(df: DataFrame, root: str = "") -> DataFrame:
    """File path, modification time and load time of every row, from the scan itself."""
    path = F.col("_metadata.file_path")
    name = F.regexp_replace(path, f"^.*{root}/", "") if root else path
    return df.select(
        "*",
        name.alias("source_filename"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("source_file_last_modified"),
        F.current_timestamp().alias("ingested_at"),
    )


def _block_starts(spot: DataFrame) -> DataFrame:
    """Per file and block the id of its first row and the rows of the file's earlier blocks."""
    blocks = spot.groupBy("_file", "_block").agg(F.count("*").alias("_rows"), F.min("_order").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )


def number_csv_rows(df: DataFrame) -> DataFrame:
    """``source_file_row_number``: the position of every row in its delimited file.

    Text files carry no row index. A scan task reads one block of a file after another, in
    order, so a row's increasing id less that of its block's first row is its place in the
    block; the rows of the file's earlier blocks are added. Only the table of blocks is windowed
    and sent to the rows, which are neither sorted nor moved. ``df`` must come straight from the scan.
    """
    spot = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    )
    joined = spot.join(F.broadcast(_block_starts(spot)), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    position = F.col("_before") + F.col("_order") - F.col("_first") + 1
    return joined.select(*df.columns, position.cast("bigint").alias("source_file_row_number"))


def parquet_row_number() -> Column:
    """The same for columnar files, where the reader knows the position."""
    return (F.col("_metadata.row_index") + 1).alias("source_file_row_number")


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match by name in any case and order; extra columns go, absent ones become null."""
    by_name: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in by_name:
            raise GuardError(f"Column {name!r} matches two headers when case is ignored.")
        by_name[name.lower()] = name
    return df.select(
        *(
            (F.col(f"`{by_name[f.name.lower()]}`") if f.name.lower() in by_name else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as nulls; leave the others alone."""
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    )


def read_mapping(spark: SparkSession, path: str, schema: T.StructType, label: str) -> DataFrame:
    """A committed mapping with clean, complete headers and at least one row."""
    df = clean_headers(spark.read.parquet(path), "spaces")
    require_columns(df, schema.names, label)
    return require_rows(df.select(*schema.names), label)


def discover_schema(spark: SparkSession, path: str) -> DataFrame:
    """Inferred names and types of a delimited extract, for inspection only."""
    inferred = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return catalog(inferred)


def catalog(df: DataFrame, count_filled: bool = False) -> DataFrame:
    """Column position, name, type, precision, scale and nullability, in table order."""
    entries = []
    for position, field in enumerate(df.schema.fields, start=1):
        decimal = isinstance(field.dataType, T.DecimalType)
        entry = [
            F.lit(position).cast("bigint").alias("column_position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.lit(field.dataType.precision if decimal else None).cast("bigint").alias("numeric_precision"),
            F.lit(field.dataType.scale if decimal else None).cast("bigint").alias("numeric_scale"),
            F.lit("YES" if field.nullable else "NO").alias("is_nullable"),
        ]
        if count_filled:
            entry.append(F.count(F.col(f"`{field.name}`")).alias("filled_rows"))
        entries.append(F.struct(*entry))
    source = df if count_filled else df.sparkSession.range(1)
    return source.agg(F.array(*entries).alias("c")).select(F.inline("c")) if count_filled else source.select(
        F.inline(F.array(*entries))
    )


# --- files --------------------------------------------------------------------------------


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and modification time; no content is read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``source_file``, ``source_file_hash``: one digest rule for files of any size.

    A file is read as lines that end in a line feed, in parallel, and digested from its length
    and from every line's position and bytes. Carriage returns belong to the line.
    Spark's listing leaves out empty files.
    """
    files = list_files(spark, path).select(F.col("path").alias("source_file"), "length")
    lines = number_csv_rows(
        spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("source_file"), "value")
    )
    digests = content_digest(lines, ["source_file"], F.md5("value"), F.col("source_file_row_number"))
    whole = F.md5(F.concat_ws("|", F.col("length").cast("string"), F.coalesce("source_file_hash", F.lit(""))))
    return files.join(digests, "source_file", "left").select("source_file", whole.alias("source_file_hash"))


def content_digest(df: DataFrame, files: Sequence[str], row_hash: Column, position: Column) -> DataFrame:
    """A digest per file from the hashes of all positions and rows, which may be added in any order."""
    placed = F.md5(F.concat_ws("|", position.cast("string"), row_hash))
    rows = df.select(*files, placed.alias("_placed"))
    words = [
        F.sum(F.conv(F.substring("_placed", start, 8), 16, 10).cast("decimal(38,0)")).alias(f"_{start}")
        for start in (1, 9, 17, 25)
    ]
    parts = rows.groupBy(*files).agg(F.count("*").alias("_n"), *words)
    digest = F.md5(F.concat_ws("|", *(F.col(n).cast("string") for n in ("_n", "_1", "_9", "_17", "_25"))))
    return parts.select(*files, digest.alias("source_file_hash"))


def new_files_only(files: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Files whose content no committed batch has; ``force`` lets all through."""
    if force:
        return files
    return files.join(manifest.select("source_file_hash").distinct(), "source_file_hash", "left_anti").select(
        *files.columns
    )


def refused_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The files whose content a committed batch has, whatever their names."""
    return files.join(manifest.select("source_file_hash").distinct(), "source_file_hash", "left_semi").select(*files.columns)


def known_snapshots(arriving: DataFrame, published: DataFrame) -> DataFrame:
    """Arriving ``snapshot_id`` values whose day has published rows, with their number."""
    held = published.groupBy("snapshot_date").agg(F.count("*").alias("published_rows"))
    day = F.try_to_date("snapshot_id", "yyyyMMdd")
    return arriving.select("snapshot_id").distinct().join(held, day == F.col("snapshot_date")).select(
        "snapshot_id", "published_rows"
    )


def newest_file(files: DataFrame, time: str = "modificationTime", path: str = "path") -> DataFrame:
    """One row: the file modified last, lock files left out."""
    visible = files.where(~F.element_at(F.split(path, "/"), -1).startswith("~$"))
    return visible.agg(F.max_by(path, F.struct(time, path)).alias(path))


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """Rows of the greatest batch id; on a partitioned table this prunes to its folder."""
    return df.where(F.col(batch) == df.agg(F.max(batch).alias("latest")).scalar())


def run_id(name: Column) -> Column:
    """The run id inside a file name when it is a real moment, else null."""
    text = empty_to_null(F.regexp_extract(name, RUN_ID, 1))
    return F.when(F.try_to_timestamp(text, F.lit("yyyyMMdd_HHmmss")).isNotNull(), text)


def snapshot_id(name: Column) -> Column:
    """The snapshot date inside a file name when it is a real day, else null."""
    text = empty_to_null(F.regexp_extract(name, SNAPSHOT_ID, 1))
    return F.when(F.try_to_date(text, "yyyyMMdd").isNotNull(), text)


def required_setting(value: str | None, description: str) -> str:
    if value is None or not value.strip():
        raise GuardError(f"A value is required for {description}.")
    return value.strip()
