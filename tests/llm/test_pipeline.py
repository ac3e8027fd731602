import random

import corpus_pipeline
from orderloom.llm import bpe_trie, bytelevel

RND = random.Random(12)
WORDS = [f"{a}{b}" for a in "ba co du fe gi ho ju ka le mi".split() for b in "ran tel vis mon dar".split()]


def prose(n):
    return " ".join(RND.choice(WORDS) for _ in range(n)).capitalize() + "."


def test_stages_take_effect(spark, documents, folder):
    item = prose(25) + " " + prose(8)
    good = [(k, prose(60)) for k in range(60)]
    rows = [
        *good,
        (100, good[0][1]), (101, good[1][1] + " Add."), (102, good[2][1]), (102, good[2][1]),
        (200, prose(30) + " " + item), (201, " ".join(f"{w.upper()}!!" for w in prose(60).split())),
        (202, prose(40) + " you idiot moron, pathetic scum " + prose(9)), (203, prose(30) + " token=abcdef0123456789ab " + prose(30)),
        (300, None), (301, ""),
    ]
    labels = spark.createDataFrame([(201, 0, 0), (202, 1, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    sf_dir = folder(
        documents=documents(*rows), labels=labels, benchmark=spark.createDataFrame([(7, item)], "item_id bigint, text string")
    )
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents().columns
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert not {201, 202} & set(kept["quality"]) and len(kept["quality"]) == len(rows) - 2
    assert kept["near_duplicates"] == sorted([*range(60), 200, 203, 300])
    assert kept["decontamination"] == kept["secrets"] == sorted([*range(60), 203, 300])
    texts = {r.doc_id: r for r in docs.collect()}
    assert "[REDACTED]" in texts[203].text and texts[203].n_chars == len(texts[203].text)
    assert all(texts[k].text == t for k, t in good)
    coded = corpus_pipeline.run(spark, sf_dir)
    back = bpe_trie.decode(coded, bytelevel.vocabulary_path())
    assert {r.doc_id: r.text for r in back.collect()} == {k: r.text or "" for k, r in texts.items()}


def test_empty_table(spark, documents, folder):
    sf_dir = folder(
        documents=documents(), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"),
        benchmark=spark.createDataFrame([], "item_id bigint, text string"),
    )
    assert corpus_pipeline.run(spark, sf_dir).count() == 0


def test_rows_without_id_or_with_one_id_stay_if_their_texts_differ(spark, documents):
    texts = [prose(60) for _ in range(8)]
    rows = [
        (1, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]),
        (5, texts[4]), (5, texts[5]), (5, texts[5]), (7, texts[6]), (6, texts[6]), (None, texts[7]),
    ]
    kept = corpus_pipeline.near_duplicate_stage(spark, documents(*rows), "")
    assert kept.columns == documents().columns
    expected = [(1, 0), (None, 1), (None, 2), (None, 3), (5, 4), (5, 5), (6, 6), (None, 7)]
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=lambda r: r[1])
    assert found == sorted(((k, texts[n]) for k, n in expected), key=lambda r: r[1])


def test_near_duplicates_keep_a_column_called_key(spark, documents, folder):
    text = prose(60)
    df = documents((1, text), (2, text), (3, prose(60))).selectExpr("*", "doc_id * 10 as _key", "'c' as component_id")
    got = corpus_pipeline.near_duplicate_stage(spark, df, folder())
    assert got.columns == df.columns
    assert sorted((r.doc_id, r._key, r.component_id) for r in got.collect()) == [(1, 10, "c"), (3, 30, "c")]
