import hashlib
import random

import pytest
from tokenizers import Tokenizer

from orderloom.llm import bytelevel, token_counts
from orderloom.llm.bpe_trie import TrieEncoder, decode, encode, op1_bpe_trie

PATH = bytelevel.vocabulary_path()
PARTS = [
    "a", "b", "aa", "the", "Thing", " ", "  ", "\n", "\t", "'s", "'ll", "1", "22", "é", "ß", "<|endoftext|>", "<|endof",
    "日本", "՘", "\x1c", "😀", "-", "---", "=", "\xa0", "don't", "I'M", "\r\n", " \n", "x" * 70, ".", ",",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    return [*made, "", " ", "a" * 5000, "\n" * 300, " " * 300, "abc " * 3000]


def little_endian(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def test_trie_encoding_equals_the_library(library, texts):
    vocabulary = bytelevel.Vocabulary(PATH)
    expected = [little_endian(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert TrieEncoder(vocabulary).encode(texts) == expected
    # A tiny memory forgets and learns again without changing a result.
    small = TrieEncoder(vocabulary, memory_words=5)
    assert [i for k in range(0, len(texts), 50) for i in small.encode(texts[k : k + 50])] == expected


def test_heap_and_plain_merging_agree(texts):
    vocabulary = bytelevel.Vocabulary(PATH)
    for text in texts[:150]:
        data = text.encode()[:200]
        assert not data or vocabulary.merged(data) == vocabulary.merged_long(data)


def test_query_digests(spark, documents, folder, library, texts):
    rows = [(k, t) for k, t in enumerate(texts[-120:])] + [(900, None), (900, None)]
    got = op1_bpe_trie(spark, folder(documents=documents(*rows))).collect()
    expected = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (key, len(ids), hashlib.sha256(little_endian(ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        )
    assert sorted(map(tuple, got)) == sorted(expected)


def test_encode_then_decode_gives_the_text_back(documents):
    df = documents((1, "Naïve café\n\n  x"), (2, None), (3, ""))
    back = decode(encode(df, PATH), PATH)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "Naïve café\n\n  x", 2: "", 3: ""}
    assert encode(documents(), PATH).count() == 0


def test_clashing_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "a b", 5, b"x")], "doc_id bigint, text string, n_tokens int, ids binary")
    assert encode(df, PATH).first().n_tokens == 2
    assert token_counts.count_tokens(df, PATH).first().n_tokens == 2


def test_whole_tokens_are_proven():
    vocabulary = bytelevel.Vocabulary(PATH)
    whole = token_counts.whole_tokens(vocabulary)
    assert b" the" in whole and all(vocabulary.merged(w) == [vocabulary.id_of[w]] for w in list(whole)[:500])


def test_token_counts_equal_the_library(spark, documents, folder, library, texts):
    rows = [(k, t) for k, t in enumerate(texts[-200:])] + [(900, None), (901, "word " * 600)]
    got = token_counts.op8_token_counts(spark, folder(documents=documents(*rows))).collect()
    expected = []
    for key, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((key, len((text or "").encode()), n, n > 512))
    assert sorted(map(tuple, got)) == sorted(expected)
