import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from orderloom.llm import conversation_trie as trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The contract, node by node, in memory."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(math.fmod(c, 5))  # the remainder has the sign of c
        full[c] = tuple(turns.get(first, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = []
    for node, own in members.items():
        below = [m for m in members if m[: len(node)] == node]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(str(c) for c in own if len(full[c]) == len(node))
        out.append((
            own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(kids[node]),
            sum(not kids[m] for m in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, conversations, longest):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(conversations * 2), conversations):
        for t in range(rnd.choice([1, 2, 3, 9, 12, longest])):
            rows.append((c, t, rnd.choice(["user", None]), rnd.choice(["a", "bé", "", None])))
    return rows


@pytest.mark.parametrize("band", [2, 8])
def test_equals_a_plain_trie(spark, band):
    rows = made(band, 60, 20)
    rows += [(1000, t, "user", f"turn {t % 3}") for t in range(70)] + [(1005, t, "user", f"turn {t % 3}") for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = trie.prefix_trie(trie.rebuilt(df), band).drop(*trie.KEY)
    assert collected(got) == plain(rows)


def test_query_with_missing_values_ties_and_other_columns(spark, folder):
    rows = [
        (0, 0, "user", "x"), (0, 1, "user", "y"), (1, 0, "user", "x"), (1, 0, "user", "x"), (None, 0, "user", "lost"),
        (2, None, "user", "first"), (2, 0, None, None), (3, 7, "user", "z" * 200_000), (-7, 1, "a", "b"), (-5, 1, "a", "b"),
        (4, 1, "b", "t"), (4, 1, "a", "t"), (4, 1, "a", "s"),
    ]
    rows += [(100, k // 40, "user", "same") for k in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "'a' as c", "2 as _part", "3 as ends")
    got = trie.op11_conversation_trie(spark, folder(conversations=df))
    assert collected(got) == plain(rows)


def test_one_conversation_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(5, t, "user", f"t{t % 7}") for t in range(300)] + [(c, t, "user", f"t{t}") for c in range(10, 20) for t in range(3)]
        got = collected(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).drop(*trie.KEY))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == plain(rows)


def test_end_lists_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 3)
    rows = [(5 * c, 0, "user", "only") for c in range(50)]
    got = collected(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))).drop(*trie.KEY))
    assert got == plain(rows)


def test_empty_table(spark):
    assert trie.prefix_trie(trie.rebuilt(spark.createDataFrame([], SCHEMA))).count() == 0
