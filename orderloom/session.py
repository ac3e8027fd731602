"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Partition counts and memory belong to the cluster.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A shuffled side whose every partition is smaller is hashed, so the other side is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# Stored bytes that a step of a batch takes on at once; it shuffles some five times as many.
PIECE_BYTES = 2**30

_local_scratch: str | None = None


def local_session(cores: str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in REQUIRED_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A temporary folder stands in only for a local master, where driver and executors
    are one process; anywhere else the setting is required.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster.")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="orderloom-")
    return _local_scratch


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/orderloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; call it once its results are written."""
    _remove(spark, _scratch_root(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def held(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` materialized for a while: its files go when the block ends, so nothing lazy may outlive it."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _stored(df, path)
    finally:
        _remove(df.sparkSession, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage so that a lost executor re-reads files instead of recomputing, freezes
    row placement for numbering, and gives the optimizer real sizes for join choices.
    """
    return _stored(df, scratch_path(df.sparkSession, label))


class Relay:
    """Hands a batch on through stored copies: each one goes once the next is stored, the last with ``clear``.

    ``relay(rows)`` stores rows. ``relay(rows, work)`` stores what ``work``, which must treat every
    row by itself, makes of them, piece by piece. So the disk holds two copies and what one step
    shuffles for one piece, however large the batch is. Nothing lazy may outlive the copy it reads.
    """

    def __init__(self, label: str):
        self.label = label
        self._rows: DataFrame | None = None
        self._copies: list[tuple[SparkSession, str]] = []

    def __call__(self, rows: DataFrame, work: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        if rows is not self._rows:
            self._store(rows.sparkSession, [rows])
        if work is not None:
            self._store(rows.sparkSession, map(work, list(self._pieces())))
        return self._rows

    def _store(self, spark: SparkSession, parts: Iterable[DataFrame]) -> None:
        path = scratch_path(spark, self.label)
        self._copies.append((spark, path))
        for part in parts:
            _release(spark)
            part.write.mode("append").option("compression", "zstd").parquet(path)
            _release(spark)
        self._rows = spark.read.schema(part.schema).parquet(path)
        self._drop(len(self._copies) - 1)

    def _pieces(self) -> Iterator[DataFrame]:
        """The last copy in runs of whole files, each of ``PIECE_BYTES`` or one file more."""
        spark, folder = self._copies[-1]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        files = [(f.getPath().toString(), f.getLen()) for f in listed if not f.getPath().getName().startswith("_")]
        rows, names, size = self._rows, [], 0
        for number, (name, length) in enumerate(files, start=1):
            names.append(name)
            size += length
            if size >= PIECE_BYTES or number == len(files):
                yield spark.read.schema(rows.schema).parquet(*names)
                names, size = [], 0

    def clear(self) -> None:
        self._drop(len(self._copies))

    def _drop(self, count: int) -> None:
        for spark, path in self._copies[:count]:
            _remove(spark, path)
        del self._copies[:count]

    def __enter__(self) -> Relay:
        return self

    def __exit__(self, *_) -> None:
        self.clear()


def _release(spark: SparkSession) -> None:
    """Let go of what ended jobs shuffled: those files stay until the driver collects its garbage.

    Spark's own setting for it, ``spark.sql.classic.shuffleDependency.fileCleanup.enabled``, stops the
    whole application if a task of a stage that is not needed any more ends after its job.
    """
    spark._jvm.System.gc()


def _stored(df: DataFrame, path: str) -> DataFrame:
    _release(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    _release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
