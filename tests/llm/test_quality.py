import random

import numpy as np
import pytest

from orderloom.llm import quality


def prose(rnd, n):
    return " ".join(rnd.choice("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()) + rnd.choice("abcdefghij") for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(8)
    rows, truth = [], {}
    for k in range(240):
        text = prose(rnd, rnd.randint(40, 120))
        kind = k % 8
        if kind == 0:
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        elif kind == 1:
            text = " | ".join(text.split())
        elif kind == 2:
            text = " ".join([rnd.choice(text.split())] * 60)
        elif kind == 3:
            text += " you moron, such a pathetic clown"
        rows.append((k, text))
        truth[k] = ("junk" if kind < 3 else "toxic" if kind == 3 else "good")
    return rows, truth


def labels(spark, truth):
    return spark.createDataFrame(
        [(k, int(t != "junk"), int(t == "toxic")) for k, t in truth.items() if k % 2],
        "doc_id bigint, quality int, toxic int",
    )


def test_kept_documents(spark, documents, folder, corpus):
    rows, truth = corpus
    extra = [(1000, None), (1001, ""), (1002, "Short."), (1003, "w " * 50_000), (4, rows[4][1])]
    sf_dir = folder(documents=documents(*rows, *extra), labels=labels(spark, truth))
    got = [r.doc_id for r in quality.op2_quality(spark, sf_dir).collect()]
    for key, kind in truth.items():
        assert (key in got) == (kind == "good"), (key, kind)
    assert {1000, 1001, 1002} <= set(got) and 1003 not in got and got.count(4) == 2
    model, _ = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), None)
    kept = quality.filter_rows(documents(*rows), model)
    assert {r.doc_id for r in kept.collect()} == {k for k, t in truth.items() if t == "good"}
    assert kept.columns == documents().columns


def test_estimated_accuracies_find_the_bad_labeller():
    rnd = np.random.default_rng(3)
    n = 20_000
    hidden = rnd.random(n) < 0.2
    right = [0.95, 0.9, 0.85, 0.7]
    votes = np.ones((n, len(quality.LABELLERS)), "u1")
    for k, p in enumerate(right):
        told = np.where(rnd.random(n) < p, hidden, ~hidden)
        votes[:, k] = np.where(rnd.random(n) < 0.2, quality.ABSTAIN, np.where(told, quality.BAD, quality.GOOD))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    task = quality.Task([0, 1, 2, 3])
    task.estimate(patterns, counts.astype("f8"))
    assert np.abs(task.right - right).max() < 0.03 and abs(task.prior - 0.2) < 0.02
    assert ((task.posterior(votes) > 0.5) == hidden).mean() > 0.95


def test_rows_without_id_are_sampled_one_by_one(spark, documents, folder, corpus):
    rows, truth = corpus
    rnd = random.Random(2)
    many = [(None, f"{text} {prose(rnd, 3)}" if truth[k] == "good" else text) for _ in range(8) for k, text in rows]
    many += [(None, rows[4][1])] * 900  # a third are copies of one clean text
    df = documents(*many)
    voted = quality.votes(df, frozenset())
    with np.errstate(all="raise", under="ignore"):
        model = quality.fit(voted, frozenset(), train_rows=400)
    assert all(np.isfinite(task.weights).all() and np.abs(task.weights).max() > 0 for task in model.tasks.values())
    kept = quality.kept(quality.score(voted, model)).count()
    assert kept == quality.filter_rows(df, model).count()
    clean = sum(truth[k] == "good" for k, _ in rows) * 8 + 900
    assert abs(kept - clean) <= clean // 50
    sf_dir = folder(documents=df, labels=labels(spark, truth))
    assert abs(quality.op2_quality(spark, sf_dir).count() - clean) <= clean // 50


def test_no_rows_teach_nothing():
    task = quality.Task([0, 1])
    task.estimate(np.empty((0, len(quality.LABELLERS)), "u1"), np.empty(0))
    with np.errstate(all="raise"):
        task.fit(np.empty((0, len(quality.LABELLERS)), "u1"), np.empty((0, quality.DIMENSIONS)))
    assert np.isfinite(task.weights).all() and task.weights[0] < 0


def test_empty_table(spark, documents, folder):
    sf_dir = folder(documents=documents(), labels=labels(spark, {1: "good"}))
    assert quality.op2_quality(spark, sf_dir).count() == 0
