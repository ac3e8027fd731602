import itertools
import math
import random

import duckdb
import numpy as np

from orderloom.llm import neighbours as nn

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double"


def brute(rows, every=20, wanted=20):
    size = {}
    usable = []
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable.append((key, [float(np.float32(x)) for x in v]))
        size[len(v)] = size.get(len(v), 0) + 1
    common = max(size, key=lambda n: (size[n], n)) if size else 0
    usable = [(k, v) for k, v in usable if len(v) == common]
    out = []
    for q, v in usable:
        if q % every:
            continue
        scored = {}
        for k, w in usable:
            if k != q:
                total = 0.0
                for a, b in zip(v, w):
                    total += a * b
                scored[k] = max(scored.get(k, -math.inf), total)
        best = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:wanted]
        out += [(q, n + 1, k, s) for n, (k, s) in enumerate(best)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, 0.5) for k, v in rows], SCHEMA)


def test_hilbert_curve_visits_neighbouring_cells():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = cells[np.argsort(nn.hilbert_keys(cells, 3))]
    assert len(set(nn.hilbert_keys(cells, 3).tolist())) == 512
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_equals_brute_force_with_copies_and_broken_vectors(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK_ROWS", 40)
    rnd = random.Random(3)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(12)]) for k in range(400)]
    same = [rnd.gauss(0, 1) for _ in range(12)]
    rows += [(1000 + k, same) for k in range(200)]
    rows += [(2000, None), (2020, [0.0] * 12), (2040, [1.0] * 11 + [math.nan]), (2060, [math.inf] * 12), (2080, [1.0] * 5),
             (2100, [None] + [1.0] * 11), (None, [1.0] * 12), (2120, []), (-20, [0.5] * 12)]
    got = sorted(map(tuple, nn.nearest(frame(spark, rows).select("vec_id", "embedding")).collect()))
    assert got == brute(rows)


def test_windows_alone_find_most_in_clusters(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK_ROWS", 100)
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(25, 16))
    rows = [(k, (centres[k % 25] + 0.1 * rnd.normal(size=16)).tolist()) for k in range(1500)]
    expected = brute(rows)
    found = {(r.query_id, r.vec_id) for r in nn.nearest(frame(spark, rows), exact=False).collect()}
    assert len(found & {(q, k) for q, _, k, _ in expected}) >= 0.9 * len(expected)


def test_chunks_change_nothing(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(6)]) for k in range(200)]
    monkeypatch.setattr(nn, "MAX_BLOCKS", 2)
    monkeypatch.setattr(nn, "CHUNK_ROWS", 20)
    assert sorted(map(tuple, nn.nearest(frame(spark, rows)).collect())) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    got = sorted(map(tuple, nn.nearest(frame(spark, rows)).collect()))
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert nn.nearest(frame(spark, [(0, None)])).count() == 0
    assert nn.nearest(frame(spark, [(0, [1.0])])).count() == 0
    assert nn.nearest(frame(spark, [(1, [1.0]), (2, [2.0])])).count() == 0


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute("create view embeddings as select * from '/root/testdata/sf0.001/embeddings.parquet'")
    got = nn.op4_neighbours(spark, "/root/testdata/sf0.001")
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(connection.execute(nn.OP4_SQL).fetchall())


def test_many_vectors_of_one_id_hide_no_other_id(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK_ROWS", 60)
    rnd = np.random.default_rng(5)
    rows = [(k, rnd.normal(size=8).tolist()) for k in range(1, 200)] * 2
    near, own = rnd.normal(size=8), rnd.normal(size=8)
    rows += [(0, near.tolist()), (1001, (3 * near).tolist())] + [(1001, (3 * near).tolist())] * 30
    rows += [(1003, (2 * near + 0.01 * rnd.normal(size=8)).tolist()) for _ in range(40)]
    rows += [(500, (own + 0.01 * rnd.normal(size=8)).tolist()) for _ in range(40)]
    best = {}
    for q, v in rows:
        for k, w in rows:
            if q % 20 == 0 and k != q:
                score = 0.0
                for a, b in zip(v, w):
                    score += float(np.float32(a)) * float(np.float32(b))
                best.setdefault(q, {})[k] = max(best.get(q, {}).get(k, -math.inf), score)
    expected = [
        (q, n + 1, k, s) for q, found in best.items()
        for n, (k, s) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:20])
    ]
    assert sorted(map(tuple, nn.nearest(frame(spark, rows)).collect())) == sorted(expected)
