"""The prefix trie of conversations, with subtree totals by a rollup over depth bands.

A node is a distinct sequence of first turns. Its key is its depth and a 128-bit XOR of one hash
per (depth, turn), so the key of the parent is known from the last turn alone, and the keys along
a conversation are a running XOR that can be taken in pieces. Turns are told apart by SHA-256.

Subtree totals climb in bands of ``BAND`` depths. Within a band every node adds its value to its
ancestors of that band, at most ``BAND`` rows per node. What a band's root has gathered is the
value of one node in the next level's trie, whose depths are counted in whole bands; that level
is rolled up the same way, until one band holds the whole depth. On the way back the completed
totals of the band roots are added to the ancestors in the band above. A trie of depth d takes
2 log(d) / log(BAND) rounds, however deep the deepest conversation is.

No conversation is gathered: rows are range-partitioned by (conversation, turn) and sorted, one
pass numbers them and takes the running XOR within a task, and what a conversation has in earlier
tasks, at most one row per task, is sent to all. A node of a third of all conversations meets
partial sums only. The list of conversations that end in a node is hashed in order, so its
decimal text, joined to pieces of ``PIECE`` ids in parallel, streams through one task per node;
nothing but the hash's state is held.

Defined cases. Rows without conv_id belong to no conversation and are left out. Null role or text
is empty. Turns of one conversation are ordered by turn, null first, then by role, then by the
first ``TIE_PREFIX`` characters of the text, then by the turn's hash; repeated rows are turns of
their own. c % 5 has the sign of c, as in SQL. Texts of any length are hashed where they are read
and not shuffled. An empty table has no nodes, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.llm.common import Batches, table, text_of
from orderloom.session import materialize

#: Depths per band: the most rows a node is turned into in one round.
BAND = 8
#: Ids per piece of the text that an end list is hashed from.
PIECE = 4096
#: Characters of a text that decide between turns of equal number and role, before the hash does.
TIE_PREFIX = 64

# Fixed values of the rebuilding: conversations per family, and what the borrowed turns are counted by.
FAMILY, BORROWED = 5, 9

KEY = ["i", "k1", "k2"]


# --- running numbers over sorted rows -----------------------------------------------------------


def running(df: DataFrame, group: str, order: Sequence[str], words: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``place``, the position in its group, and ``words`` replaced by their running XOR.

    ``group`` is a long without nulls, ``words`` are longs; ``place``, ``_part`` and columns that
    start with ``_before`` must be free.
    """
    keys, names, words = [group, *order], df.columns, list(words)
    schema = T.StructType([*df.schema.fields]).add("place", "long").add("_part", "integer")

    def walk(batches: Batches) -> Batches:
        part, last, count, held = TaskContext.get().partitionId(), None, 0, [0] * len(words)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(names.index(group)).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            begun = np.repeat(starts, np.diff(np.append(starts, n)))
            place = np.arange(1, n + 1) - begun
            # The first run may go on from the batch before.
            head = slice(0, (starts[1] if len(starts) > 1 else n) if ids[0] == last else 0)
            place[head] += count
            columns = dict(zip(names, batch.columns, strict=True))
            for k, name in enumerate(words):
                own = batch.column(names.index(name)).to_numpy()
                whole = np.bitwise_xor.accumulate(own)
                now = whole ^ whole[begun] ^ own[begun]
                now[head] ^= held[k]
                columns[name], held[k] = pa.array(now), now[-1]
            last, count = ids[-1], place[-1]
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(place), pa.array(np.full(n, part, "int32"))], names=[*columns, "place", "_part"]
            )

    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialize(sorted_rows.mapInArrow(walk, schema), "running")
    ends = placed.groupBy(group, "_part").agg(
        F.max("place").alias("_rows"), *(F.max_by(w, "place").alias(f"_x_{w}") for w in words)
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        F.col(group).alias("_before_group"), F.col("_part").alias("_before_part"),
        F.sum("_rows").over(earlier).alias("_before"), *(F.bit_xor(f"_x_{w}").over(earlier).alias(f"_before_{w}") for w in words),
    ).where("_before > 0")
    # Only a task's first group can have rows in earlier tasks: at most one row per task.
    here = (F.col(group) == F.col("_before_group")) & (F.col("_part") == F.col("_before_part"))
    joined = placed.join(F.broadcast(before), here, "left")
    moved = {w: F.col(w).bitwiseXOR(F.coalesce(F.col(f"_before_{w}"), F.lit(0))) for w in words}
    return joined.select(
        *(moved[n].alias(n) if n in moved else F.col(n) for n in names),
        (F.col("place") + F.coalesce("_before", F.lit(0))).alias("place"),
    )


# --- the conversations as rebuilt ---------------------------------------------------------------


def borrowed(conversation: Column) -> Column:
    """How many turns a conversation takes from its family's first one."""
    return F.crc32(conversation.cast("string").cast("binary")) % BORROWED


def rebuilt(df: DataFrame) -> DataFrame:
    """``c, i, digest, n_bytes, ends``: every conversation's rebuilt turns, depth ``i`` from 1, and its depth-0 row.

    ``df`` has ``conv_id, turn, role, text``. The depth-0 row has no digest. ``ends`` marks a
    conversation's last row.
    """
    role, text = text_of("role"), text_of("text")
    turn_text = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = df.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").alias("t"), role.alias("r"),
        F.substring(text, 1, TIE_PREFIX).alias("x"), F.unhex(F.sha2(turn_text, 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    owned = running(turns, "c", ["t", "r", "x", "digest"]).select("c", "place", "digest", "n_bytes")

    c = F.col("c")
    sizes = owned.groupBy("c").agg(F.max("place").alias("n"))
    sizes = sizes.select("c", "n", (c - c % FAMILY).alias("first"), borrowed(c).alias("h"))
    firsts = sizes.select(c.alias("first"), F.col("n").alias("first_n"))
    taken = F.least("h", F.coalesce("first_n", F.lit(0)))
    own = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = sizes.join(firsts, "first", "left").select("c", "first", "h", taken.alias("taken"), (taken + own).alias("length"))
    plan = materialize(plan, "conversations")

    heads = owned.where((c % FAMILY == 0) & (F.col("place") < BORROWED)).withColumnRenamed("c", "first")
    lent = heads.join(plan, "first").where("place <= h").select("c", F.col("place").alias("i"), "digest", "n_bytes", "length")
    kept = owned.where(F.col("place") > borrowed(c)).join(plan, "c").select(
        "c", (F.col("place") - F.col("h") + F.col("taken")).alias("i"), "digest", "n_bytes", "length"
    )
    roots = plan.select("c", F.lit(0).cast("bigint").alias("i"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("n_bytes"), "length")
    rows = lent.unionByName(kept).unionByName(roots)
    return rows.select("c", "i", "digest", "n_bytes", (F.col("i") == F.col("length")).alias("ends"))


# --- the trie -----------------------------------------------------------------------------------


def _links(paths: DataFrame, band: int) -> DataFrame:
    """Per node the ancestors it adds to: ``i, k1, k2, tail, above``.

    ``paths`` has ``c`` and the keys along it. A node's own band gives the ancestors up to itself
    (``tail`` false). The root of a band also links, as a tail, to the whole band before.
    """
    node = F.struct(*KEY).alias("node")
    slot = F.floor(F.col("i") / band)
    roots = paths.where((F.col("i") % band == 0) & (F.col("i") > 0))
    rows = paths.select("c", slot.alias("b"), node).union(roots.select("c", slot - 1, node))
    grouped = rows.groupBy("c", "b").agg(F.array_sort(F.collect_list("node")).alias("path"))  # band + 1 entries at most
    spread = grouped.select("path", F.posexplode("path").alias("at", "node"))
    above = F.slice("path", F.lit(1), F.least(F.col("at") + 1, F.lit(band)))
    linked = spread.select("node.*", (F.col("at") == band).alias("tail"), above.alias("above"))
    # All conversations of a node share its ancestors.
    return linked.groupBy(*KEY, "tail").agg(F.any_value("above").alias("above"))


def _climb(values: DataFrame, links: DataFrame, tail: bool) -> DataFrame:
    """The sums that ``values`` (a key and two numbers) give to the ancestors its links name."""
    added = values.join(links.where(F.col("tail") == tail), KEY).select("leaves", "saved", F.explode("above").alias("a"))
    return added.groupBy("a").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select("a.*", "leaves", "saved")


def subtree_totals(values: DataFrame, paths: DataFrame, deepest: int, band: int = BAND) -> DataFrame:
    """``i, k1, k2, leaves, saved``: the two numbers of ``values`` summed over each node's subtree."""
    levels = []
    while True:
        links = materialize(_links(paths, band), "links")
        within = materialize(_climb(values, links, False), "within")
        levels.append((links, within))
        if deepest < band:
            break
        up = (F.col("i") / band).cast("bigint").alias("i")
        values = within.where(F.col("i") % band == 0).select(up, "k1", "k2", "leaves", "saved")
        paths = paths.where(F.col("i") % band == 0).select("c", up, "k1", "k2")
        deepest //= band
    totals = levels.pop()[1]
    while levels:
        links, within = levels.pop()
        done = totals.select((F.col("i") * band).alias("i"), "k1", "k2", "leaves", "saved")
        both = within.unionByName(_climb(done, links, True))
        totals = materialize(both.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")
    return totals


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``i, k1, k2, ends_sha256`` of each node's ``c`` values, ascending, in decimal, comma-joined."""

    def pieces(batches: Batches) -> Batches:
        for batch in batches:
            key = [batch.column(k).to_numpy() for k in range(3)]
            ids, n = batch.column(3).to_pylist(), batch.num_rows
            if not n:
                continue
            change = np.zeros(n - 1, bool)
            for values in key:
                change |= values[1:] != values[:-1]
            out = []
            starts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for a, b in zip(starts, [*starts[1:], n], strict=True):
                for at in range(a, b, PIECE):
                    out.append((at, ",".join(map(str, ids[at : min(at + PIECE, b)]))))
            at = pa.array([k for k, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in range(4)), pa.array([x for _, x in out])], names=[*KEY, "c", "ids"]
            )

    def fold(batches: Batches) -> Batches:
        key, state = None, None
        named = lambda rows: pa.RecordBatch.from_pydict(
            {**{n: pa.array([r[0][k] for r in rows], pa.int64()) for k, n in enumerate(KEY)}, "ends_sha256": pa.array([r[1] for r in rows], pa.string())}
        )
        for batch in batches:
            out, columns = [], [batch.column(k).to_pylist() for k in (0, 1, 2, 4)]
            for i, k1, k2, text in zip(*columns, strict=True):
                if (i, k1, k2) == key:
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = (i, k1, k2), hashlib.sha256()
                state.update(text.encode())
            yield named(out)
        if key is not None:
            yield named([(key, state.hexdigest())])

    order = [*KEY, "c"]
    named = "i bigint, k1 bigint, k2 bigint"
    cut = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, f"{named}, c bigint, ids string")
    return cut.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(fold, f"{named}, ends_sha256 string")


def prefix_trie(rows: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie over sequences given as ``c, i, digest, n_bytes, ends``.

    Every sequence ``c`` has one row per depth ``i`` without gaps, from its digest-less row at 0.
    Returns the key (``i, k1, k2``), the node's numbers, and its parent's smallest member.
    """
    salted = lambda *parts: F.when(F.col("i") == 0, F.lit(0)).otherwise(F.xxhash64(*parts)).cast("bigint")
    hashed = rows.select("c", "i", "n_bytes", "ends", salted("i", "digest").alias("f1"), salted("digest", "i").alias("f2"))
    keyed = hashed.withColumns({"k1": F.col("f1"), "k2": F.col("f2")})
    keyed = materialize(running(keyed, "c", ["i"], ["k1", "k2"]).drop("place"), "paths")

    parent = {f"p{n}": F.col(f"k{n}").bitwiseXOR(F.col(f"f{n}")) for n in (1, 2)}
    grouped = keyed.withColumns(parent).groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    grouped = materialize(grouped, "nodes")
    children = grouped.where("i > 0").groupBy((F.col("i") - 1).alias("i"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children")
    )
    nodes = materialize(grouped.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    values = nodes.select(
        *KEY, (F.col("n_children") == 0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")
    )
    deepest = nodes.agg(F.max("i")).first()[0] or 0
    totals = subtree_totals(values, keyed.select("c", *KEY), deepest, band)

    # The root is the parent of the most nodes by far; its member is one value and needs no join.
    root = nodes.where("i = 0").select("conv_id")
    upper = nodes.select((F.col("i") + 1).alias("i"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    near = nodes.where("i <= 1").withColumn("parent_conv_id", F.when(F.col("i") == 1, root.scalar()))
    placed = near.unionByName(nodes.where("i > 1").join(upper, ["i", "p1", "p2"]))
    ends = _end_hashes(keyed.where("ends"))
    return placed.join(totals, KEY).join(ends, KEY, "left").select(
        *KEY, "conv_id", F.col("i").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations"))).drop(*KEY)


# The same by SQL: node keys are hashes of whole sequences, and subtrees are found along the smallest member's path.
OP11_SQL = """
with turns as (
  select conv_id c, coalesce(role, '') r, coalesce(text, '') x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) place
  from conversations where conv_id is not null
), sizes as (
  select c, max(place) n, c - c % 5 f,
    xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(c::varchar, ''),
      lambda b: [ascii(b)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda s, b: case when b >= 0 then xor(s, b) when s % 2 = 1 then xor(s // 2, 3988292384::bigint) else s // 2 end),
      4294967295::bigint) % 9 h
  from turns group by c
), plan as (
  select s.c, s.f, s.h, least(s.h, coalesce(p.n, 0)) k, least(s.h, coalesce(p.n, 0)) + greatest(s.n - s.h, 0) len
  from sizes s left join sizes p on p.c = s.f
), rows_ as (
  select p.c, t.place i, t.r, t.x, p.len from plan p join turns t on t.c = p.f and t.place <= p.h
  union all
  select p.c, t.place - p.h + p.k, t.r, t.x, p.len from plan p join turns t on t.c = p.c and t.place > p.h
), paths as (
  select c, i, len, x, md5(list(sha256(length(r) || ':' || r || x)) over (partition by c order by i)::varchar) k from rows_
  union all
  select c, 0, len, '', '' from plan
), up as (
  select c, i, len, x, k, lag(k) over (partition by c order by i) p from paths
), nodes as (
  select i, k, min(p) p, min(c) c, count(*) n, max(octet_length(encode(x))) b,
    sha256(coalesce(string_agg(case when i = len then c::varchar end, ',' order by c), '')) e
  from up group by i, k
), counted as (
  select n.*, coalesce(m.n_children, 0) n_children
  from nodes n left join (select i - 1 i, p k, count(*) n_children from nodes where i > 0 group by all) m on m.i = n.i and m.k = n.k
), totals as (
  select q.i, q.k, count(*) filter (where n.n_children = 0) n_leaves, sum((n.n - 1) * n.b) saved
  from counted n join paths q on q.c = n.c and q.i <= n.i group by q.i, q.k
)
select n.c as conv_id, n.i::bigint as depth, a.c as parent_conv_id, n.n as n_convs, n.n_children, t.n_leaves,
  t.saved::bigint as saved_tokens, n.e as ends_sha256
from counted n join totals t on t.i = n.i and t.k = n.k left join nodes a on a.i = n.i - 1 and a.k = n.p
"""
