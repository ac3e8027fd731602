"""Documents into shards of near-equal bytes by balanced label propagation.

Documents with equal texts are linked. Each starts in a shard that its id decides. A round
joins every linked document with the shard that holds most of its neighbours' bytes; those that
want to move do so under the quotas of their target shards. Groups are admitted from small to
large, so many whole groups come together before a very large one takes what is left; of the
size class at the margin a hashed share is admitted. An overfull shard then keeps the linked rows whose
bytes, summed in the order of their texts, stay within the mean. The rest, and documents without
links, are laid on a line and cut so that every shard is filled to the mean.

A group's neighbours are its bytes per shard, at most one row per group and shard, so links are
never listed pair by pair, and a group with a third of all rows is one partial sum per task.
Only sums per shard and size class come to the driver: at most shards x 64 rows a round.

Law: ``bytes``. Every load differs from the mean by at most the size of the largest document: kept rows
never exceed the mean, and each end of a shard's piece of the line is off by half a document at most.

Defined cases: null text has size 1 and links with empty texts; a very long text stays one row, so it alone
may be more than the mean; repeated rows are rows of their
own; a null id is allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import table, text_of
from orderloom.operators.numbering import number_rows
from orderloom.session import materialize

SHARDS = 8
MAX_ROUNDS = 6
_DICE = 1 << 30


def _dice(*columns: str | Column) -> Column:
    """An even number in [0, 1) that the columns decide."""
    return F.pmod(F.xxhash64(*columns), F.lit(_DICE)) / _DICE


def _choose(pairs: dict, keys: list[Column], default: float) -> Column:
    """A literal lookup of at most shards x 64 entries."""
    out = F.lit(default)
    for key, value in pairs.items():
        match = F.lit(True)
        for column, part in zip(keys, key if isinstance(key, tuple) else (key,)):
            match = match & (column == part)
        out = F.when(match, F.lit(float(value))).otherwise(out)
    return out


def _loads(df: DataFrame) -> dict[int, int]:
    return {r.shard: int(r.load) for r in df.groupBy("shard").agg(F.sum("size").alias("load")).collect()}


def _admissions(wants: list, loads: dict[int, int], mean: float, shards: int) -> dict[tuple[int, int], float]:
    """(target, size class) -> admitted share, smaller classes first, within each target's room."""
    shares = {}
    room = {s: max(0.0, mean - loads.get(s, 0)) for s in range(shards)}
    for want in sorted(wants, key=lambda r: (r.target, r.scale)):
        share = min(1.0, room[want.target] / want.bytes)
        room[want.target] -= share * want.bytes
        if share > 0:
            shares[(want.target, want.scale)] = share
    return shares


def propagate(linked: DataFrame, mean: float, shards: int, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Move ``linked`` rows (text_key, row_hash, size, shard, ...) towards their group's main shard."""
    for turn in range(rounds):
        cells = linked.groupBy("text_key", "shard").agg(F.sum("size").alias("bytes"))
        heaviest = F.max_by("shard", F.struct("bytes", F.xxhash64("text_key", "shard")))
        goals = cells.groupBy("text_key").agg(
            heaviest.alias("target"), F.floor(F.log2(F.sum("bytes").cast("double"))).cast("int").alias("scale")
        )
        aimed = materialize(linked.join(goals, "text_key"), "aimed")
        movers = aimed.where("shard <> target")
        wants = movers.groupBy("target", "scale").agg(F.sum("size").cast("double").alias("bytes")).collect()
        if not wants:
            break
        shares = _admissions(wants, _loads(linked), mean, shards)
        if not shares:
            break
        share = _choose(shares, [F.col("target"), F.col("scale")], 0.0)
        # Whole groups share a dice, but one larger than a shard's share must be split.
        alone = F.when(F.pow(F.lit(2.0), F.col("scale")) > mean / 4, F.col("row_hash")).otherwise(F.lit(0))
        moves = (F.col("shard") != F.col("target")) & (_dice(F.lit(turn), "text_key", alone) < share)
        linked = materialize(
            aimed.withColumn("shard", F.when(moves, F.col("target")).otherwise(F.col("shard"))).drop("target", "scale"),
            "propagated",
        )
    return linked


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the bytes of the partition's earlier rows to each row."""
    import numpy as np

    before = 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        ends = before + np.cumsum(sizes, dtype="i8")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ends - sizes)], names=[*batch.schema.names, "inside"]
        )
        before = int(ends[-1]) if len(ends) else before


def _on_a_line(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with the bytes ``before`` each row in that order, and the bytes of all."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", part int, inside bigint"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    laid = materialize(placed.mapInArrow(_running, schema), "laid")
    # One row per partition.
    sums = sorted((r.part, int(r.bytes)) for r in laid.groupBy("part").agg(F.sum("size").alias("bytes")).collect())
    starts, at = [], 0
    for part, size in sums:
        starts.append((part, at))
        at += size
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "part int, earlier bigint")
    # One row per partition of the step before: bounded by the partition count.
    joined = laid.join(F.broadcast(offsets), "part")
    return joined.select(*df.columns, (F.col("inside") + F.col("earlier")).alias("before")), at


def _trimmed(linked: DataFrame, mean: float) -> DataFrame:
    """``linked`` with ``kept``: whether its shard's bytes up to and with the row stay within the mean."""
    loads, starts, at = _loads(linked), {}, 0
    for shard in sorted(loads):
        starts[shard] = at
        at += loads[shard]
    laid, _ = _on_a_line(linked, ["shard", "text_key", "row_hash"])
    used = F.col("before") + F.col("size") - _choose(starts, [F.col("shard")], 0.0)
    return materialize(laid.withColumn("kept", used <= mean).drop("before"), "trimmed")


def fill(pool: DataFrame, missing: dict[int, float]) -> DataFrame:
    """Lay ``pool`` on a line and cut it into the shards' missing bytes, in shard order."""
    laid, total = _on_a_line(pool, ["text_key", "row_hash"])
    short = sum(missing.values()) or 1.0
    cuts, at = [], 0.0
    for shard in sorted(missing):
        at += missing[shard] * total / short
        cuts.append((shard, at))
    place = F.col("before") + F.col("size") / 2
    shard = F.lit(cuts[-1][0])
    for number, end in reversed(cuts[:-1]):
        shard = F.when(place < end, F.lit(number)).otherwise(shard)
    return laid.withColumn("shard", shard.cast("int")).select(*pool.columns)


def shard_documents(
    df: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, size, text_crc32, text_key, shard, slot`` per row."""
    text = text_of(text_column)
    rows = materialize(
        df.select(
            F.col(id_column),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("text_key"),
        ).select(
            "*",
            F.xxhash64(id_column, "text_key", F.monotonically_increasing_id()).alias("row_hash"),
            F.pmod(F.xxhash64(id_column), F.lit(shards)).cast("int").alias("shard"),
        ),
        "sized",
    )
    mean = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    groups = rows.groupBy("text_key").agg(F.count("*").alias("n")).where("n > 1").select("text_key")
    groups = materialize(groups, "groups")
    linked = propagate(materialize(rows.join(groups, "text_key"), "linked"), mean, shards)
    linked = _trimmed(linked.select(*rows.columns), mean)
    kept = linked.where("kept").drop("kept")
    loads = _loads(kept)
    pool = rows.join(groups, "text_key", "left_anti").unionByName(linked.where("not kept").drop("kept"))
    filled = fill(pool, {s: mean - loads.get(s, 0) for s in range(shards)})
    placed = kept.select(*rows.columns).unionByName(filled.select(*rows.columns))
    numbered = number_rows(placed, ["row_hash"], ["shard"], "slot")
    return numbered.select(
        id_column, "size", "text_crc32", "text_key", "shard", (F.col("slot") - 1).alias("slot")
    )


def cut_links(sharded: DataFrame) -> DataFrame:
    """Over all groups of equal texts: rows, and rows outside their group's main shard."""
    cells = sharded.groupBy("text_key", "shard").count()
    groups = cells.groupBy("text_key").agg(F.sum("count").alias("n"), F.max("count").alias("main")).where("n > 1")
    return groups.agg(F.sum("n").alias("linked"), F.sum(F.col("n") - F.col("main")).alias("apart"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
