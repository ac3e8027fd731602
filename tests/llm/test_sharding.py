import random
import zlib

import pytest

from orderloom.llm.sharding import cut_links, op9_sharding, shard_documents


def check(rows, given):
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in rows) == sorted(
        str((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for d, t in given
    )
    loads = {}
    for r in rows:
        loads.setdefault(r.shard, []).append(r)
    for held in loads.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    sizes = [sum(r.size for r in loads.get(s, [])) for s in range(8)]
    largest, mean = max(r.size for r in rows), sum(sizes) / 8
    assert all(abs(size - mean) <= largest for size in sizes)  # the stated bound
    return max(sizes) - min(sizes), largest


@pytest.mark.parametrize("hot", [0, 400])
def test_even_bytes_and_few_cut_links(spark, documents, folder, hot):
    rnd = random.Random(4)
    given = [(k, f"text {k} " + "x" * rnd.randint(1, 300)) for k in range(600)]
    given += [(1000 + 10 * k + c, f"copied {k} " + "é" * 40) for k in range(40) for c in range(4)]
    given += [(5000 + k, "hot " * 30) for k in range(hot)] + [(9000, None), (9001, ""), (9001, "")]
    found = shard_documents(documents(*given))
    found.cache()
    spread, largest = check(found.collect(), given)
    assert spread <= 2 * largest
    links = cut_links(found).first()
    assert links.apart <= (0.02 * links.linked if not hot else hot)
    rows = op9_sharding(spark, folder(documents=documents(*given))).collect()
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_only_copies_of_one_text(documents):
    given = [(k, "same text over and over") for k in range(900)]
    spread, largest = check(shard_documents(documents(*given)).collect(), given)
    assert spread <= 2 * largest


@pytest.mark.parametrize("copies, size, small", [(40, 500, 50), (24, 1000, 0), (3, 9000, 20), (9, 100, 0)])
def test_few_large_copies_keep_the_bound(documents, copies, size, small):
    given = [(k, "x" * size) for k in range(copies)] + [(1000 + k, f"small {k}") for k in range(small)]
    check(shard_documents(documents(*given)).collect(), given)


def test_many_rows_without_an_id(documents):
    given = [(None, f"text {k} " + "y" * (k % 90)) for k in range(500)] + [(None, "same") for _ in range(300)]
    check(shard_documents(documents(*given)).collect(), given)


def test_empty_and_tiny_tables(documents):
    assert shard_documents(documents()).count() == 0
    assert shard_documents(documents((None, None), (1, "a"))).count() == 2
