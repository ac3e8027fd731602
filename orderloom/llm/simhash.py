"""Near-duplicate documents by SimHash fingerprints and one-wildcard segment signatures.

A fingerprint's 64 bits are cut into three segments. Of four differing bits or fewer, one
segment gets at most one, so linked fingerprints agree on one segment but for one bit. Each
distinct fingerprint is indexed under its 64 signatures, one for every bit made a wildcard
inside its segment; equal signatures meet, and the full distance is verified.

For filtering, ``near_duplicates(wide=True)`` verifies what the signatures find, and what MinHash bands
find besides, on the shingles themselves, see ``overlap``.

Only distinct fingerprints are indexed, so exact copies never meet each other. A signature
that more than ``BLOCK`` fingerprints share is worked off in pairs of blocks, each of bounded
size. From a block only a spanning forest of its verified links leaves, never all its pairs;
that keeps every component whole.

Defined cases: null and empty texts have fingerprint zero and link like any other; repeated
rows share their fingerprint; a null id takes part without naming a component; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, table, text_of
from orderloom.llm.components import components
from orderloom.llm.overlap import near_copies
from orderloom.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# First bit and length of each segment of a 64-bit word; MAX_BITS // len(SEGMENTS) must be 1.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
BLOCK = 2048
_CHUNK = 1 << 16


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> tuple[int, ...]:
    """SimHash of the text's shingles of ``width`` words, repeats included, as signed 64-bit words."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return (0,)
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    total, counts = len(words) - width + 1, np.zeros(64, "i8")
    for start in range(0, total, _CHUNK):
        part = words[start : start + _CHUNK + width - 1]
        # Digests are big-endian: reversed, bit k of the number is bit k of the array.
        hashes = b"".join([xxhash.xxh64_digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(width)))])
        rows = np.frombuffer(hashes, "u1").reshape(-1, 8)[:, ::-1]
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype="i8")
    return tuple(np.packbits(counts * 2 > total, bitorder="little").view("<i8").tolist())


def fingerprints(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = SHINGLE_WORDS
) -> DataFrame:
    """``id, print`` per row; prints are signed longs."""
    kind = df.schema[id_column].dataType.simpleString()

    def run(columns):
        return {id_column: columns[id_column], "print": [fingerprint(t, width)[0] for t in columns["text"]]}

    return map_rows(df.select(id_column, text_of(text_column).alias("text")), run, f"`{id_column}` {kind}, print bigint")


def _words(df: DataFrame) -> list[str]:
    return [n for n in ("print", "print2") if n in df.columns]


def _signatures(prints: DataFrame) -> DataFrame:
    """64 rows per fingerprint word: ``bucket`` holds the wildcard's place above its segment's other bits."""
    found = []
    for k, word in enumerate(_words(prints)):
        for start, length in SEGMENTS:
            segment = F.shiftrightunsigned(word, start).bitwiseAND(F.lit((1 << length) - 1))
            for bit in range(length):
                rest = segment.bitwiseAND(F.lit(~(1 << bit)))
                found.append((rest + F.lit((64 * k + start + bit) << 22)).cast("int"))
    return prints.select(*prints.columns, F.explode(F.array(*found)).alias("bucket"))


def _linked(prints: np.ndarray, keys: np.ndarray, buckets: np.ndarray, bits: int) -> Iterator[tuple[int, int]]:
    """Positions of a spanning forest of the verified links inside each run of equal keys."""
    left = np.arange(len(keys) - 1)
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    for step in range(1, len(keys)):
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        if not len(left):
            break
        apart = prints[:, left] ^ prints[:, left + step]
        near = np.bitwise_count(apart).sum(0) <= bits
        kept, apart = left[near], apart[:, near]
        # A link counts at its first signature only; the pair meets there as well.
        place = buckets[kept].astype("i8") >> 22
        first = np.full(len(kept), -1, "i8")
        for k in range(len(prints) - 1, -1, -1):
            for start, length in SEGMENTS[::-1]:
                part = (apart[k] >> np.uint64(start)) & np.uint64((1 << length) - 1)
                ones = np.bitwise_count(part)
                at = 64 * k + start + np.bitwise_count((part - np.uint64(1)) & ~part).astype("i8")
                first = np.where(ones == 0, 64 * k + start, np.where(ones == 1, at, first))
        for k in kept[place == first].tolist():
            x, y = root(k), root(k + step)
            if x != y:
                parent[x] = y
                yield k, k + step


def _link_groups(bits: int):
    """Rows (bucket, unit, node, words) come sorted; a group that ends a batch waits for the next one."""

    def links(held: list[np.ndarray]) -> pa.RecordBatch:
        buckets, units, nodes, *prints = held
        keys = np.cumsum(np.r_[0, (np.diff(buckets) != 0) | (np.diff(units) != 0)]) if len(buckets) else buckets
        pairs = np.array(list(_linked(np.stack(prints).view("u8"), keys, buckets, bits)), "i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(nodes[pairs[:, 0]]), pa.array(nodes[pairs[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).astype("i8") for c in batch.columns]
            # The single word of the narrow form names its own node.
            new = new if len(new) > 3 else [*new, new[2]]
            held = [np.concatenate(pair) for pair in zip(held, new)] if held else new
            changes = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0))
            if len(changes):
                cut = changes[-1] + 1
                yield links([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if held:
            yield links(held)

    return run


def links(prints: DataFrame, block: int = BLOCK, bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints; they connect all that signatures find within ``bits``.

    Nodes are the fingerprints, or in the wide form hashes of their two words.
    """
    words = _words(prints)
    node = [] if len(words) == 1 else [F.xxhash64(*words).alias("node")]
    indexed = _signatures(prints)
    hot = materialize(indexed.groupBy("bucket").count().where(F.col("count") > block), "hot-signatures")
    blocks = F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(*words), F.col("blocks")).cast("int")
    # A row of a hot signature joins every pair of blocks that its own block is part of.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    unit = F.least("own", "other") * F.col("blocks").cast("bigint") + F.greatest("own", "other")
    dealt = (
        indexed.join(hot, "bucket", "left")
        .select("bucket", *words, blocks.alias("blocks"))
        .select("*", own.alias("own"), other.alias("other"))
        .select("bucket", unit.cast("bigint").alias("unit"), *words)
    )
    placed = dealt.repartition("bucket", "unit").sortWithinPartitions("bucket", "unit", *words)
    return placed.select("bucket", "unit", *node, *words).mapInArrow(_link_groups(bits), "a bigint, b bigint")


def near_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", wide: bool = False
) -> DataFrame:
    """``id, print, component_id`` per row; the component is its smallest id, over any chain of links.

    ``wide`` links texts of which four fifths of the five-word shingles agree, and has ``node`` for
    ``print``; ids must then be neither null nor repeated.
    """
    if wide:
        return near_copies(df, id_column, text_column)
    printed = materialize(fingerprints(df, id_column, text_column), "fingerprints")
    words = _words(printed)
    classes = materialize(printed.groupBy(*words).agg(F.min(id_column).alias("least")), "fingerprint-classes")
    node = F.col("print") if len(words) == 1 else F.xxhash64(*words)
    member = components(links(classes.select(*words)))
    joined = classes.withColumn("node", node).join(member, "node", "left")
    joined = joined.withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(joined.join(least, "component").select(*words, "component_id"), "fingerprint-components")
    return printed.join(named, words).select(id_column, *words, "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
