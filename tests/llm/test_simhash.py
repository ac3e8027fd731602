import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from orderloom.llm import simhash
from orderloom.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """prints: id -> fingerprint. Every pair is compared."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and label[b] > label[a]:
                    label[b], changed = label[a], True
    return label


def test_fingerprints_equal_a_plain_count(documents):
    texts = ["", None, "one", "one two three", "a b c d", "A B\tc\x0bd e", "é É x y z \x85 q", "w " * 500, "Ä b  c   d"]
    found = {r.doc_id: r.print for r in simhash.fingerprints(documents(*enumerate(texts))).collect()}
    assert {k: v % (1 << 64) for k, v in found.items()} == {k: plain_fingerprint(t) for k, t in enumerate(texts)}


def test_fingerprint_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    assert simhash.fingerprint("a b c d") == (row.h,)


def test_links_equal_brute_force(spark):
    rnd = random.Random(5)
    prints = set()
    for _ in range(25):
        centre = rnd.getrandbits(64)
        prints.add(centre)
        for _ in range(12):
            other = centre
            for bit in rnd.sample(range(64), rnd.randint(1, 6)):
                other ^= 1 << bit
            prints.add(other)
    signed = np.array(sorted(prints), "u8").view("i8").tolist()
    df = spark.createDataFrame([(p,) for p in signed], "print bigint")
    expected = plain_components({p: p % (1 << 64) for p in signed})
    linked = {r.node: r.component for r in components(simhash.links(df)).collect()}
    groups = lambda label: {frozenset(k for k in label if label[k] == v) for v in label.values()}
    assert {g for g in groups(expected) if len(g) > 1} == groups(linked)
    # Tiny blocks send the same rows through pairs of blocks.
    blocked = {r.node: r.component for r in components(simhash.links(df, block=3)).collect()}
    assert groups(blocked) == groups(linked)


def test_near_duplicates_whole(documents, folder, spark):
    rnd = random.Random(2)
    base = [" ".join(f"w{rnd.randint(0, 900)}" for _ in range(120)) for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, t + " extra") for k, t in enumerate(base)] + [(200, base[0]), (200, base[0]), (201, None), (202, "")]
    got = simhash.op7_simhash(spark, folder(documents=documents(*rows))).collect()
    prints = {k: plain_fingerprint(t) for k, t in rows}
    label = plain_components(prints)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (k, f"{prints[k]:016x}", label[k]) for k, _ in rows
    )


def test_empty_table_and_null_ids(documents):
    assert simhash.near_duplicates(documents().select("doc_id", "text")).count() == 0
    found = simhash.near_duplicates(documents((None, "a b c d e"), (3, "a b c d e"))).collect()
    assert {r.component_id for r in found} == {3}


def test_wide_form_links_texts_that_agree_by_four_fifths(documents):
    rnd = random.Random(4)
    rows, groups = [], 40
    for k in range(groups):
        words = [f"w{rnd.randint(0, 5000)}" for _ in range(250)]
        rows.append((10 * k, " ".join(words)))
        for c in (1, 2):
            other = list(words)
            for at in rnd.sample(range(250), 4):
                other[at] = f"x{rnd.randint(0, 5000)}"
            rows.append((10 * k + c, " ".join(other)))
    rows += [(1000 + k, " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(250))) for k in range(200)]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(*rows), wide=True).collect()}
    assert all(found[k] == k for k in range(1000, 1200))
    assert all(found[k] // 10 == k // 10 for k in found if k < 1000)
    assert sum(found[10 * k + c] == 10 * k for k in range(groups) for c in (1, 2)) >= 0.75 * 2 * groups
    twice = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents((1, ""), (2, None), (3, "a")), wide=True).collect()}
    assert twice == {1: 1, 2: 1, 3: 3}
