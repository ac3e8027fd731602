"""Nearest neighbours by shifted Hilbert curves, finished exactly.

Vectors are projected to a few orthogonal directions, shifted, and put in the order of a Hilbert
curve; every curve has its own directions and shift. Spark partitions each order into ranges of
keys, blocks of about ``BLOCK_ROWS`` vectors. A query meets its own key range and the two next
to it on every curve, and the windows' results merge and are ranked again on exact scores.

The windows give each query a score to beat. A block's centre and radius bound the inner
product any of its vectors can reach, so in a second pass a query visits the blocks of the first
curve that could still beat it, and no others; the result is exact. On vectors with structure
few blocks are left; on evenly spread ones, where no index helps, it becomes a search of the
query set in blocks.

Directions, shifts and the key ranges' borders are fitted on about ``SAMPLE_ROWS`` vectors that
a hash of the id picks; every vector is indexed. Keys end in a hash of the id, so equal vectors
spread over as many ranges as they fill. Beyond ``MAX_BLOCKS`` blocks, blocks are dealt out in
chunks, which bounds both the block table that is broadcast and the rows of one task.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows without id or with another length than most; ties go to the smaller id; with fewer
candidates than wanted all are returned; a repeated id appears once in a result, with its best
score, and as a query it stands for all its vectors; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, shared, table
from orderloom.session import materialize

NEAREST = 20
QUERY_EVERY = 20
CURVES = 3
DIRECTIONS = 8
BITS = 6
TIE_BITS = 15
BLOCK_ROWS = 1024
MAX_BLOCKS = 4096
CHUNK_ROWS = 8192
SAMPLE_ROWS = 50_000
SEED = 17


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of rows of ``bits``-bit cell coordinates."""
    axes = [cells[:, k].astype("i8") for k in range(cells.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:  # undo the rotations of ever smaller cells
        low = bit - 1
        for k in range(len(axes)):
            upper = (axes[k] & bit) != 0
            swap = np.where(upper, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = axes[0] ^ np.where(upper, low, swap)
            axes[k] = axes[k] ^ swap if k else axes[k]
        bit >>= 1
    for k in range(1, len(axes)):  # Gray code
        axes[k] = axes[k] ^ axes[k - 1]
    turn, bit = np.zeros_like(axes[0]), 1 << (bits - 1)
    while bit > 1:
        turn = turn ^ np.where(axes[-1] & bit, bit - 1, 0)
        bit >>= 1
    key = np.zeros_like(axes[0])
    for place in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> place) & 1)
    return key


@dataclass
class Curves:
    """What places a vector on every curve, and the borders of each curve's blocks."""

    directions: np.ndarray  # curve, dimension, direction
    low: np.ndarray  # curve, direction: projected value of cell 0
    width: np.ndarray  # curve, direction: projected width of all cells
    borders: list[np.ndarray]
    chunks: int = 1

    def keys(self, curve: int, vectors: np.ndarray, ties: np.ndarray) -> np.ndarray:
        seen = (vectors @ self.directions[curve] - self.low[curve]) / self.width[curve]
        cells = np.clip(seen * (1 << BITS), 0, (1 << BITS) - 1).astype("i8")
        return (hilbert_keys(cells) << TIE_BITS) | (ties & ((1 << TIE_BITS) - 1))

    def blocks(self, curve: int, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders[curve], keys, "right")


def fit_curves(vectors: np.ndarray, ties: np.ndarray, total: int) -> Curves:
    """Orthogonal random directions, shifts of part of a cell range, and even key ranges."""
    rnd = np.random.default_rng(SEED)
    size = vectors.shape[1]
    k = min(DIRECTIONS, size)
    directions = np.stack([np.linalg.qr(rnd.normal(size=(size, size)))[0][:, :k] for _ in range(CURVES)])
    blocks = int(np.clip(-(-total // BLOCK_ROWS), 1, MAX_BLOCKS))
    lows, widths = [], []
    for curve in range(CURVES):
        seen = vectors @ directions[curve]
        low, high = np.quantile(seen, [0.005, 0.995], axis=0)
        width = np.maximum(high - low, 1e-12) * 1.25
        lows.append(low - rnd.random(k) * 0.2 * width)
        widths.append(width)
    out = Curves(directions, np.array(lows), np.array(widths), [], max(1, -(-total // blocks // CHUNK_ROWS)))
    for curve in range(CURVES):
        keys = np.sort(out.keys(curve, vectors, ties))
        out.borders.append(np.unique(keys[np.arange(1, blocks) * len(keys) // blocks]))
    return out


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype("f8") if values else np.zeros((0, 1))


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component to the last."""
    total = np.zeros(len(queries))
    for k in range(queries.shape[1]):
        total = total + queries[:, k] * vectors[:, k]
    return total


def _best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray, wanted: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query its best ``wanted`` ids, with their best scores, of these vectors that reach ``least``.

    A repeated id counts once towards the wanted ones, and the query's own id not at all.
    """
    out = [], [], []
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    names, firsts = np.unique(ids, return_index=True)
    step = max(1, (1 << 22) // max(1, len(ids)))
    for start in range(0, len(queries), step):
        part = slice(start, start + step)
        rough = queries[part] @ vectors.T
        room = 1e-9 * (1 + np.abs(rough).max(initial=0))
        bar = least[part] - room
        rough[query_ids[part][:, None] == ids[None, :]] = -np.inf
        if len(names) > wanted:
            best = np.maximum.reduceat(rough, firsts, axis=1) if len(names) < len(ids) else rough
            bar = np.maximum(bar, np.partition(best, -wanted, axis=1)[:, -wanted] - room)
        row, column = np.nonzero((rough >= bar[:, None]) & (rough > -np.inf))
        score = _exact(queries[part][row], vectors[column])
        # The best score of each id, which comes first, stays.
        order = np.lexsort((-score, ids[column], row))
        row, column, score = row[order], column[order], score[order]
        once = np.r_[True, (np.diff(row) != 0) | (np.diff(ids[column]) != 0)][: len(row)]
        row, column, score = row[once], column[once], score[once]
        order = np.lexsort((ids[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < wanted
        for held, new in zip(out, (query_ids[part][row[top]], ids[column[top]], score[top])):
            held.append(new)
    return tuple(np.concatenate(o) if o else np.zeros(0, t) for o, t in zip(out, ("i8", "i8", "f8")))


def _usable(embedding: str) -> Column:
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0)


def _stored(df: DataFrame, id_column: str, embedding: str) -> tuple[DataFrame, str, int]:
    """Usable vectors as bytes of their own precision, with a tie-breaking hash; their kind and length."""
    double = df.schema[embedding].dataType.simpleString() == "array<double>"
    kind, element = ("f8", "double") if double else ("f4", "float")
    rows = df.where(_usable(embedding) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(embedding).cast(f"array<{element}>").alias("e")
    )
    lengths = rows.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = lengths.n if lengths else 1

    def pack(columns):
        return {
            "vec_id": columns["vec_id"],
            "tie": columns["tie"],
            "v": [np.array(e, kind).tobytes() for e in columns["e"]],
        }

    kept = rows.where(F.size("e") == size).select("vec_id", F.xxhash64(F.lit(SEED), "vec_id").alias("tie"), "e")
    # Repeated rows are settled here, so that copies of one id cannot fill a block.
    packed = map_rows(kept, pack, "vec_id bigint, tie bigint, v binary").dropDuplicates(["vec_id", "v"])
    return materialize(packed, "vectors"), kind, size


def _indexed(stored: DataFrame, curves, kind: str, numbers: range) -> DataFrame:
    """A row per vector and curve with its block."""

    def run(columns):
        vectors, ties = _matrix(columns["v"], kind), np.array(columns["tie"], "i8")
        fitted, out = curves(), {"curve": [], "block": [], "vec_id": [], "v": [], "chunk": []}
        for curve in numbers:
            out["curve"] += [curve] * len(ties)
            out["block"] += fitted.blocks(curve, fitted.keys(curve, vectors, ties)).tolist()
            out["chunk"] += ((ties >> TIE_BITS) % fitted.chunks).tolist()
            out["vec_id"] += columns["vec_id"]
            out["v"] += columns["v"]
        return out

    return map_rows(stored, run, "curve int, block int, chunk int, vec_id bigint, v binary")


def _search(kind: str, wanted: int):
    """Cogrouped by block: the queries sent to it meet its vectors."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        found = _best(
            query_ids, _matrix(right["q"].to_pylist(), kind), ids, _matrix(left["v"].to_pylist(), kind),
            right["least"].to_numpy(), wanted,
        ) if len(ids) and len(query_ids) else (np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0))
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    return run


_FOUND = "query_id bigint, vec_id bigint, score double"


def _meet(vectors: DataFrame, queries: DataFrame, kind: str, wanted: int) -> DataFrame:
    keys = ("curve", "block", "chunk")
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_search(kind, wanted), _FOUND)


def _ranked(found: DataFrame, wanted: int) -> DataFrame:
    """The best ``wanted`` of each query. A query has at most that many rows per block it visited."""
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # Best first: structs sort by negated score, then id.
    row = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i"))
    best = single.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(row)), 1, wanted).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.i").alias("vec_id"), (-F.col("b.s")).alias("score")
    )


def _summaries(first: DataFrame, kind: str) -> list[tuple[int, np.ndarray, float, int]]:
    """Per block of the first curve: centre and radius, merged from partial sums per chunk."""

    def run(t: pa.Table) -> pa.Table:
        v = _matrix(t["v"].to_pylist(), kind)
        centre = v.mean(0)
        radius = float(np.sqrt(((v - centre) ** 2).sum(1).max()))
        return pa.table({"block": pa.array([t["block"][0].as_py()], pa.int32()), "c": [centre.tobytes()], "r": [radius], "n": [len(v)]})

    rows = first.groupBy("block", "chunk").applyInArrow(run, "block int, c binary, r double, n bigint").collect()
    by_block: dict[int, list] = {}
    for r in rows:
        by_block.setdefault(r.block, []).append((np.frombuffer(r.c, "f8"), r.r, r.n))
    out = []
    for block, parts in sorted(by_block.items()):
        n = sum(p[2] for p in parts)
        centre = sum(p[0] * p[2] for p in parts) / n
        out.append((block, centre, max(p[1] + float(np.linalg.norm(p[0] - centre)) for p in parts), n))
    return out


def nearest(
    df: DataFrame, id_column: str = "vec_id", embedding: str = "embedding", every: int = QUERY_EVERY,
    wanted: int = NEAREST, exact: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``wanted`` of every ``every``-th id's vector.

    ``exact=False`` stops after the curves' windows, which shows what they find alone.
    """
    spark = df.sparkSession
    stored, kind, _ = _stored(df, id_column, embedding)
    total = stored.count()
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rate = min(1.0, SAMPLE_ROWS / total)
    picked = stored.where(F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    sample = picked.select("tie", "v").collect() or stored.select("tie", "v").limit(1).collect()
    fitted = fit_curves(_matrix([bytes(r.v) for r in sample], kind), np.array([r.tie for r in sample], "i8"), total)
    curves = shared(spark, fitted)
    indexed = _indexed(stored, curves, kind, range(CURVES))
    is_query = F.col("vec_id") % every == 0
    near = F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(fitted.chunks - 1)))
    own = indexed.where(is_query).select("curve", "block", F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    windows = own.select("curve", near.alias("block"), "query_id", "q", F.lit(float("-inf")).alias("least"))
    windows = windows.select("curve", "block", chunk.alias("chunk"), "query_id", "q", "least")
    found = materialize(_ranked(_meet(indexed, windows, kind, wanted), wanted), "windows")
    if not exact:
        return found
    first = _indexed(stored, curves, kind, range(1))
    # At most MAX_BLOCKS rows of a centre and a radius.
    summary = shared(spark, _summaries(first, kind))
    bars = found.groupBy("query_id").agg(
        F.when(F.count("*") >= wanted, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least")
    )
    asked = own.where("curve = 0").join(bars, "query_id", "left").select(
        "query_id", "q", "block", F.coalesce("least", F.lit(float("-inf"))).alias("least")
    )

    def visits(columns):
        blocks = summary()
        number = np.array([b for b, _, _, _ in blocks])
        centres, radii = np.array([c for _, c, _, _ in blocks]), np.array([r for _, _, r, _ in blocks])
        queries, home = _matrix(columns["q"], kind), np.array(columns["block"])
        reach = queries @ centres.T + np.linalg.norm(queries, axis=1)[:, None] * radii[None, :]
        least = np.array(columns["least"], "f8")
        open_ = (reach * (1 + 1e-9) + 1e-9 >= least[:, None]) & (np.abs(number[None, :] - home[:, None]) > 1)
        row, column = np.nonzero(open_)
        return {
            "block": number[column].tolist(), "query_id": [columns["query_id"][k] for k in row],
            "q": [columns["q"][k] for k in row], "least": least[row].tolist(),
        }

    if asked.isEmpty():
        return found
    visited = map_rows(asked, visits, "block int, query_id bigint, q binary, least double", rows=256)
    visited = visited.select(F.lit(0).alias("curve"), "block", chunk.alias("chunk"), "query_id", "q", "least")
    more = _meet(first, visited, kind, wanted)
    return _ranked(found.select("query_id", "vec_id", "score").unionByName(more), wanted)


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP4_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
