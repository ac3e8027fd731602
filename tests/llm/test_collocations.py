import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from orderloom.llm import collocations as col

SCHEMA = "doc_id bigint, text string, lang string"


def tokens_of(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", small)]


def plain_counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for words in tokens_of(text):
            n[lang or "und"] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        f[lang or "und", tuple(words[i : i + k])] += 1
    return f, n


def plain(rows, least=100, top=2000):
    """The contract, phrase by phrase."""
    f, n = plain_counts(rows)
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = {}
    for (lang, words), a in candidates.items():
        score, _, l, r = min(
            (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
            for k in range(1, len(words))
        )
        inside = any(
            q[0] == lang and len(q[1]) > len(words) and b >= a
            and any(q[1][i : i + len(words)] == words for i in range(len(q[1])))
            for q, b in candidates.items()
        )
        if not inside:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), " ".join(words), l, r))
    return sorted(
        (lang, rank, phrase, -a, l, r, n[lang], -score)
        for lang, found in out.items() for rank, (score, a, _, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def made(seed, docs):
    rnd = random.Random(seed)
    vocabulary = ["a", "B", "é", "the", "New", "york", "city", "of", "ü x", "x-y", "\x1c", "日本", "😀"] + [f"rare{k}" for k in range(400)]
    rows = []
    for k in range(docs):
        words = []
        for _ in range(rnd.randint(0, 60)):
            words += rnd.choice([["new", "york", "city"], ["NEW", "york"], ["a", "a", "a"], [rnd.choice(vocabulary)], [rnd.choice(vocabulary[:8])]])
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ! "]) for w in words)
        rows.append((k % 50, text, rnd.choice(["en", "en", None, "und", "de"])))
    return rows


def collected(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_equals_a_plain_count(spark, folder):
    rows = made(1, 1200) + [(None, None, "en"), (7, "", None), (8, "word " * 20_000, "xx"), (9, "a" * 200_000, "xx"), (10, " ., ", "yy")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' as phrase", "1 as w1", "2 as n")
    got = collected(col.op13_collocations(spark, folder(documents=df)))
    assert got == plain(rows) and len({r[0] for r in got}) >= 3


def test_small_top_and_empty_table(spark):
    rows = made(2, 600)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(col.collocations(df, top=3)) == plain(rows, top=3)
    assert col.collocations(df.where("false")).count() == 0


@pytest.mark.parametrize("bits", [6, 12, 28])
def test_cut_windows_keep_all_frequent_counts(monkeypatch, bits):
    """However few buckets there are, and wherever texts are cut, frequent phrases keep their counts."""
    rows = made(bits, 300)
    for name, value in {"FILTER_BITS": bits, "BLOCK_BITS": min(bits, 16) - 2, "PART": 40, "HELD": 50, "REMEMBERED": 9, "HITS": 500, "LEAST": 20}.items():
        monkeypatch.setattr(col, name, value)
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])

    def bitmap(short=None):
        counts = pa.Table.from_batches(col._bucket_counts(short)([batch])).sort_by("block").combine_chunks()
        size, found = 1 << col.BLOCK_BITS - 3, bytearray(1 << bits - 3)
        for piece in col._block_bits(counts.to_batches()):
            for block, held in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                found[block * size : (block + 1) * size] = held
        return lambda: bytes(found)

    short = bitmap()
    prefixes, total = Counter(), Counter()
    found = pa.Table.from_batches(col._windows(short, bitmap(short))([batch])).sort_by("part").combine_chunks()
    for out in col._merged(found.to_batches()):
        for lang, window, n in zip(*(c.to_pylist() for c in out.columns), strict=True):
            words = tuple(window.split(" ")) if window else ()
            total[lang] += n
            for k in range(1, len(words) + 1):
                prefixes[lang, words[:k]] += n
    f, n = plain_counts(rows)
    assert total == n
    assert {p: c for p, c in f.items() if c >= 20} == {p: c for p, c in prefixes.items() if c >= 20}


def test_runs_cover_every_window_once(monkeypatch):
    text = " ".join(f"w{k}" if k % 7 else "end." for k in range(500))
    whole = next(col.token_runs(text))[0]
    monkeypatch.setattr(col, "PART", 13)
    seen = [tuple(t[k : k + 5]) for t, fresh in col.token_runs(text) for k in range(fresh)]
    assert seen == [tuple(whole[k : k + 5]) for k in range(len(whole))]
