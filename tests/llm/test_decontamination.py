import random

import numpy as np
import pytest

from orderloom.llm import decontamination as d


def made(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


WORDS = [f"w{k}" for k in range(60)] + [f"rare{k}" for k in range(400)]


@pytest.fixture(scope="module")
def items():
    rnd = random.Random(6)
    return [(k, f"{made(rnd, rnd.randint(8, 40))}. {made(rnd, rnd.randint(5, 9))}.") for k in range(70)] + [
        (70, ""), (71, None), (72, "Two words"), (73, "word"),
    ]


def plain_scores(index, ids):
    """BM25 of every item for a set of words, without bounds."""
    scores = np.zeros(len(index.keys))
    for k in set(ids[ids >= 0].tolist()):
        for e in range(index.first[k], index.first[k + 1]):
            scores[index.item_of[e]] += index.worth_of[e]
    return scores


def test_block_bounds_lose_nothing(items):
    rnd = random.Random(1)
    index = d.Index([(k, t or "") for k, t in items], block_items=4)
    texts = [np.array([rnd.randint(-1, len(index.word_ids) - 1) for _ in range(n)], "i8") for n in (1, 3, 50, 400, 900)]
    texts += [np.array([index.word_ids[w] for w in d.words_of(items[k][1])], "i8") for k in (0, 5)]
    got = {(t, s, i): round(x, 9) for t, s, i, x in index.retrieve(texts)}
    expected = {}
    for t, ids in enumerate(texts):
        for start in index.starts(len(ids)).tolist():
            scores = plain_scores(index, ids[start : start + index.window])
            expected |= {(t, start, int(i)): round(float(scores[i]), 9) for i in np.flatnonzero(scores >= index.least)}
    assert got == expected and len(got) > 2


def test_leaks_are_found_and_clean_documents_left(spark, documents, folder, items):
    rnd = random.Random(2)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    whole = {k: t for k, t in items if t and k < 70}
    rows, truth = [], set()
    for k in range(40):
        rows.append((k, made(rnd, rnd.randint(0, 300))))
    for k in range(30):
        rows.append((100 + k, f"{made(rnd, rnd.randint(0, 400))} {whole[k].upper()} {made(rnd, 200)}"))
        truth.add((100 + k, k))
    rows.append((200, made(rnd, 30_000) + " " + whole[9] + " " + made(rnd, 30_000)))
    truth.add((200, 9))
    rows.append((201, whole[12].split(". ")[0]))  # the question alone
    rows += [(202, None), (203, ""), (204, "well, two WORDS!"), (205, whole[3]), (205, whole[3])]
    truth |= {(204, 72), (205, 3)}
    sf_dir = folder(documents=documents(*rows), benchmark=benchmark)
    got = d.op3_decontamination(spark, sf_dir).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert truth <= found and len(got) == len(found) + 1
    assert all(r.question_overlap >= 0.8 and r.answer_overlap >= 0.8 for r in got)
    clean = {r.doc_id for r in d.remove_leaks(documents(*rows), benchmark).collect()}
    assert clean == {k for k, _ in rows} - {k for k, _ in found}
    assert {k for k, i in found} - {k for k, i in truth} <= {k for k, t in rows if t and "word" in t.split()}
    slices = d.INDEX_ITEMS, d.GATHERED
    try:
        # Few items in a slice and short pieces of long texts change no row and no figure.
        for d.INDEX_ITEMS, d.GATHERED in ((20, 0), (7, slices[1])):
            assert sorted(map(str, d.op3_decontamination(spark, sf_dir).collect())) == sorted(map(str, got))
            assert {r.doc_id for r in d.remove_leaks(documents(*rows), benchmark).collect()} == clean
    finally:
        d.INDEX_ITEMS, d.GATHERED = slices


def test_empty_tables(spark, documents, items):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert d.find_leaks(documents((1, "a b c")), none).count() == 0
    assert d.remove_leaks(documents((1, "a b c")), none).count() == 1
    assert d.find_leaks(documents(), spark.createDataFrame(items, "item_id bigint, text string")).count() == 0
    only = spark.createDataFrame([(1, ""), (2, None)], "item_id bigint, text string")
    assert d.find_leaks(documents((1, "a b c")), only).count() == 0
