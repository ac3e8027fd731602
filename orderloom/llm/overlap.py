"""Near copies of texts: four fifths of their distinct five-word shingles agree.

Candidates come from two searches. SimHash fingerprints that differ in four bits or fewer meet by
one-wildcard signatures, see ``simhash``. MinHash bands find what those miss: ``BANDS`` bands of
``ROWS`` minima each meet on equal values; a pair at the bar of 0.8 shares one of them with a
probability of 0.9999, a closer one more surely. Every candidate pair is verified on the distinct shingles both hold against those either
holds. Shingles are compared as 64-bit hashes, written once for each text that meets another; the
comparison of the first round is a built-in function on two arrays, so Spark bounds and spills what it
holds. No pair below the bar is linked.

Texts with equal sets of shingles are one class and never meet each other. In a first round the
classes of a band meet one of them, picked anew for each band, which joins most of what belongs
together. In a second round all pairs of a band meet that are still in different components, so
every candidate pair is verified or is already joined by verified links. They meet inside tasks: a
band comes as blocks of bounded size, two at a time, with the hashes of its sets, and only a spanning
forest of its verified links leaves, never its pairs. A pair is compared in the first band it shares.
At the bar the larger set is at most 5/4 of the smaller. ``APART`` differing bits of 128, one of every
minimum, rule a pair out before its hashes are compared; a pair at the bar differs in 12.8 with a
deviation of 3.4.

Defined cases: null and empty texts have no shingles and equal each other; a text of fewer words
is one shingle; an empty table gives an empty result; ids must be neither null nor repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import map_rows, text_of
from orderloom.llm.components import components
from orderloom.session import materialize

WIDTH = 5
BANDS, ROWS = 24, 5
HASHES = 128
APART = 32
BLOCK = 2048
# Hashes of the sets in one block, 16 MB; a larger set is a block of its own at worst.
BLOCK_HASHES = 1 << 21
SEED = 42
_rnd = np.random.default_rng(SEED)
_FLIP = _rnd.integers(0, 1 << 64, (HASHES, 1), "u8")
_ODD = _rnd.integers(0, 1 << 64, (HASHES, 1), "u8") | np.uint64(1)
_CHUNK = 1024
_PIECE = 1 << 16


def shingles(text: str) -> set[bytes]:
    """The distinct shingles; only A-Z change case and only ASCII white space splits."""
    words = text.encode().lower().split()
    if len(words) < WIDTH:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[k:] for k in range(WIDTH)))))


def agree(a: set[bytes], b: set[bytes]) -> bool:
    """Whether the sets have a Jaccard similarity of four fifths or more."""
    both = len(a & b)
    return 5 * both >= 4 * (len(a) + len(b) - both)


def hashes(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles; a very long text is hashed piece by piece."""
    import xxhash

    words = text.encode().lower().split()
    width = WIDTH if len(words) >= WIDTH else max(1, len(words))
    found = np.empty(0, "u8")
    for start in range(0, len(words) - width + 1, _PIECE):
        part = words[start : start + _PIECE + width - 1]
        digests = b"".join([xxhash.xxh3_64_digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(width)))])
        found = np.union1d(found, np.frombuffer(digests, "u8"))
    return found


def sketch(text: str) -> tuple[int, int, int, int, list[int]]:
    """A hash of the set of shingles, its size, 128 bits of its minima as two numbers, and the bands; all signed."""
    import xxhash

    own = hashes(text)
    least = np.full(HASHES, np.iinfo("u8").max, "u8")
    for start in range(0, len(own), _CHUNK):
        mixed = (own[None, start : start + _CHUNK] ^ _FLIP) * _ODD
        np.minimum(least, mixed.min(1), out=least)
    bits = np.packbits(((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype("u1"), bitorder="little")
    low, high = bits.view("<i8").tolist()
    kept = least.astype("<u8").tobytes()
    bands = [xxhash.xxh3_64_intdigest(kept[8 * ROWS * k : 8 * ROWS * (k + 1)], k) for k in range(BANDS)]
    node = xxhash.xxh3_64_intdigest(own.tobytes())
    return node - (node >> 63 << 64), len(own), low, high, [b - (b >> 63 << 64) for b in bands]


def _near(a: str, b: str) -> Column:
    apart = [F.bit_count(F.col(f"{a}.{n}").bitwiseXOR(F.col(f"{b}.{n}"))) for n in ("low", "high")]
    n, m = F.col(f"{a}.size"), F.col(f"{b}.size")
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & ((apart[0] + apart[1]) <= APART)


def _sets(nodes: DataFrame, classes: DataFrame, plain: DataFrame, id_column: str) -> DataFrame:
    """``node, bands, hashes`` of the classes that ``nodes`` names, from the text of each one's least id."""
    named = classes.join(nodes, "node", "left_semi").select(F.col("least").alias(id_column), "node", "bands")
    wanted = materialize(named, "wanted")

    def run(columns):
        return {**columns, "hashes": [hashes(t).view("i8") for t in columns["text"]]}

    texts = plain.join(wanted, id_column).select("node", "bands", "text")
    schema = "node bigint, bands array<bigint>, hashes array<bigint>"
    return materialize(map_rows(texts, run, schema, rows=256), "shingle-hashes")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets agree."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("hashes").alias(f"set_{n}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return materialize(joined.where(5 * both >= 4 * either).select("a", "b"), "overlaps")


def _first_pairs(members: DataFrame) -> DataFrame:
    """Every member of a band with the one its band picks."""
    pick = F.min(F.struct(F.xxhash64("band", "node").alias("order"), "node", "size", "low", "high")).alias("c")
    centre = members.groupBy("band").agg(pick).select("band", "c.node", "c.size", "c.low", "c.high")
    met = members.alias("m").join(centre.alias("c"), "band").where("m.node <> c.node").where(_near("m", "c"))
    return met.select(F.greatest("m.node", "c.node").alias("b"), F.least("m.node", "c.node").alias("a")).distinct()


def _linked(band: int, apart: bool, own: np.ndarray, rows: dict[str, np.ndarray], ids: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between components among rows of one band; ``apart``: of two blocks, ``own``."""
    size, low, high, bands = (rows[n] for n in ("size", "low", "high", "bands"))
    component, mark = rows["component"].copy(), np.zeros(1 + max(int(i.max(initial=0)) for i in ids), "i4")
    for k in range(len(size) - 1):
        after = slice(k + 1, None)
        differ = np.bitwise_count(low[after] ^ low[k]).astype("i4") + np.bitwise_count(high[after] ^ high[k])
        near = 5 * np.minimum(size[after], size[k]) >= 4 * np.maximum(size[after], size[k])
        near &= (differ <= APART) & (component[after] != component[k])
        if apart:
            near &= own[after] != own[k]
        met = np.flatnonzero(near) + k + 1
        if len(met):
            met = met[bands[k][(bands[met] == bands[k]).argmax(1)] == band]
        if not len(met):
            continue
        mark[ids[k]] = 1
        both = np.add.reduceat(mark[np.concatenate([ids[m] for m in met.tolist()])], np.cumsum(size[met]) - size[met])
        mark[ids[k]] = 0
        for m in met[9 * both >= 4 * (size[met] + size[k])].tolist():
            if component[m] != component[k]:
                component[component == component[m]] = component[k]
                yield k, m


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list starts and ends, and all values."""
    held = column.combine_chunks()
    return held.offsets.to_numpy(), held.values.to_numpy()


def _link_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by band and unit; a group that ends a batch waits for the next one."""

    def links(t: pa.Table, edges: list[int]) -> pa.RecordBatch:
        plain = {n: t[n].to_numpy() for n in ("band", "apart", "own", "node", "component", "size", "low", "high")}
        at, values = _lists(t["hashes"])
        starts, bands = _lists(t["bands"])
        plain |= {n: plain[n].view("u8") for n in ("low", "high")}  # of signed numbers the bits of the amount would count
        plain["bands"] = bands[starts[0] : starts[-1]].reshape(-1, BANDS)
        found = []
        for a, b in zip(edges, edges[1:]):
            if b - a < 2:
                continue
            ids = np.unique(values[at[a] : at[b]], return_inverse=True)[1]
            rows = {n: c[a:b] for n, c in plain.items()}
            pairs = _linked(rows["band"][0], rows["apart"][0], rows["own"], rows, np.split(ids, at[a + 1 : b] - at[a]))
            found += [(rows["node"][k], rows["node"][m]) for k, m in pairs]
        ends = np.array(found, "i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(ends.min(1)), pa.array(ends.max(1))], names=["a", "b"])

    held = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, new]) if held is not None else new
        band, unit = held["band"].to_numpy(), held["unit"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(band) != 0) | (np.diff(unit) != 0)) + 1).tolist()]
        if len(edges) > 1:
            yield links(held, edges)
            held = held.slice(edges[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield links(held, [0, held.num_rows])


def _open_pairs(members: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Verified links between different components of a band, a spanning forest of each pair of blocks.

    ``nodes``: node, component, bands, hashes.
    """
    named = members.join(nodes.select("node", F.coalesce("component", "node").alias("component")), "node")
    sizes = named.groupBy("band").agg(
        F.count("*").alias("n"), F.sum("size").alias("held"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("held") / BLOCK_HASHES)).cast("int")
    open_ = materialize(sizes.where("x <> y").select("band", blocks.alias("blocks")), "open-bands")
    # A row joins every pair of blocks that its own block is part of.
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    dealt = named.join(open_, "band").select("*", own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    unit = F.least("own", "other") * F.col("blocks").cast("bigint") + F.greatest("own", "other")
    # Where two blocks meet, each was paired within itself elsewhere.
    apart = F.floor(unit / F.col("blocks")) != unit % F.col("blocks")
    placed = dealt.withColumns({"unit": unit, "apart": apart}).join(nodes.select("node", "bands", "hashes"), "node").select(
        "band", "unit", "apart", "own", "node", "component", "size", "low", "high", "bands", "hashes"
    )
    return placed.repartition("band", "unit").sortWithinPartitions("band", "unit").mapInArrow(_link_bands, "a bigint, b bigint")


def _signed_pairs(classes: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Classes of one fingerprint with the least of them, and the least ones of linked fingerprints."""
    least = materialize(classes.groupBy("print").agg(F.min("node").alias("low"), F.count("*").alias("n")), "class-prints")
    same = classes.join(least.where("n > 1"), "print").where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    named = lambda n: least.select(F.col("print").alias(n), F.col("low").alias(f"low_{n}"))
    near = links(least.select("print")).join(named("a"), "a").join(named("b"), "b")
    near = near.select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    return same.union(near)


def near_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK) -> DataFrame:
    """``id, node, component_id`` per row; the component is its smallest id, over any chain of links."""
    from orderloom.llm import simhash  # which offers this function under its own name

    fingerprint, links = simhash.fingerprint, simhash.links
    kind = df.schema[id_column].dataType.simpleString()
    plain = df.select(id_column, text_of(text_column).alias("text"))

    def run(columns):
        node, size, low, high, bands = zip(*map(sketch, columns["text"])) if columns["text"] else ((),) * 5
        prints = [fingerprint(t)[0] for t in columns["text"]]
        return {id_column: columns[id_column], "node": node, "size": size, "low": low, "high": high, "bands": bands, "print": prints}

    schema = f"`{id_column}` {kind}, node bigint, size int, low bigint, high bigint, bands array<bigint>, print bigint"
    printed = materialize(map_rows(plain, run, schema, rows=256), "sketches")
    firsts = [F.first(n).alias(n) for n in ("size", "low", "high", "bands")] + [F.min("print").alias("print")]
    classes = materialize(printed.groupBy("node").agg(F.min(id_column).alias("least"), *firsts), "sketch-classes")
    members = classes.select("node", "size", "low", "high", F.explode("bands").alias("band"))
    several = members.groupBy("band").count().where("count > 1").select("band")
    members = materialize(members.join(several, "band", "left_semi"), "band-members")
    signed = _signed_pairs(classes.select("node", "print"), links)
    first = materialize(_first_pairs(members).select("a", "b").union(signed).distinct(), "first-pairs")
    sets = _sets(_ends(first).union(members.select("node")).distinct(), classes, plain, id_column)
    links = _verified(first, sets)
    rest = _open_pairs(members, sets.join(components(links), "node", "left"), block)
    member = components(links.union(materialize(rest, "open-links")))
    joined = classes.select("node", "least").join(member, "node", "left")
    joined = joined.withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(joined.join(least, "component").select("node", "component_id"), "copy-components")
    return printed.select(id_column, "node").join(named, "node").select(id_column, "node", "component_id")
