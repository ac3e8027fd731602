import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from orderloom.llm import context_mixing as cm


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(80)]
    out = []
    for k in range(220):
        text, word = [], rnd.randrange(80)
        for _ in range(rnd.randint(0, 80)):
            word = (word * 7 + rnd.choice((1, 2))) % 80 if rnd.random() < 0.9 else rnd.randrange(80)
            text.append(words[word].upper() if rnd.random() < 0.1 else words[word])
        out.append((k, " ".join(text)))
    return out + [(900, None), (901, ""), (902, "un\x85known Ä words\there\x0b"), (903, "w1 " * 30_000), (5, out[5][1])]


def plain(rows):
    held = {k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in rows}
    count = Counter()
    for k, t in rows:
        if not held[k]:
            count.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(count.values()), len(count)
    out = []
    for k, t in rows:
        words = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((k, held[k], len(words), sum(count[w] > 0 for w in words), n, round(base, 6)))
    return out


def test_counts_and_base_equal_a_plain_pass_and_the_model_beats_it(spark, documents, folder, rows, monkeypatch):
    monkeypatch.setattr(cm, "TOP_WORDS", 40)
    got = cm.op5_context_mixing(spark, folder(documents=documents(*rows))).collect()
    found = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str
    )
    assert found == sorted(plain(rows), key=str)
    unseen = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(unseen) > 20 and sum(r.score for r in unseen) > 0.9 * sum(r.base_score for r in unseen)
    assert all(r.score <= 0 for r in got)


def test_blocks_do_not_change_scores(documents, rows, monkeypatch):
    score = lambda: {(r.doc_id, round(r.score, 8)) for r in cm.score_texts(documents(*rows[:60])).collect()}
    whole = score()
    monkeypatch.setattr(cm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(cm, "LANES", 7)
    assert score() == whole


def test_probabilities_of_the_next_token_sum_to_one():
    rnd = np.random.default_rng(2)
    common = [(f"t{k}".encode(), int(c)) for k, c in enumerate(rnd.integers(1, 90, 30))]
    others = [(f"o{k}".encode(), int(c)) for k, c in enumerate(rnd.integers(1, 4, 20))]
    rare = sum(c + 0.5 for _, c in others) + 0.5
    code = cm.build_code(common, rare)
    tables = rnd.integers(0, 30, (cm.CONTEXTS, 1 << cm.TABLE_BITS, 2)).astype("u4")
    mixer = cm.Mixer(code, tables, cm.first_weights() + rnd.normal(size=(cm.DEPTHS * cm.SEEN, cm.INPUTS)) * 0.2)
    words = cm.Words(code)
    spend = lambda text: float(mixer.bits_of(words.look(text), np.array([len(text)]), cm.RATE)[0])
    before = [b"t3", b"o1"] * 10
    spent = spend(before)
    total = 0.0
    for word, count in [*common, *others, (b"unknown", 0)]:
        p = 2 ** -(spend([*before, word]) - spent)
        total += p if word in code.number else p * (count + 0.5) / rare
    assert abs(total - 1) < 1e-6


def test_texts_read_at_once_have_the_numbers_of_their_words():
    code = cm.build_code([(b"the", 9), (b"", 7), ("é".encode(), 5), (b"x", 2)], 30)
    texts = ["The x  unknown é\x85 the", "", " \n", "x" * 300 + " THE", "a b\x0bc\td"]
    flat = [w for t in texts for w in cm.tokens(t)]
    seen, lengths = cm.HashedWords(code).look([t.encode().lower() for t in texts])
    assert lengths.tolist() == [len(cm.tokens(t)) for t in texts]
    assert (seen == cm.Words(code).look(flat)[:, :2]).all()
    assert len({int(h) for h in cm.spelled(b"a aa aaa b ab ba abc acb")[1]}) == 8


def test_tables_merge_in_levels(spark, documents, rows, monkeypatch):
    monkeypatch.setattr(cm, "FAN_IN", 2)
    texts = documents(*rows[:40]).select("text").where("text is not null").repartition(7)
    code = cm.build_code([(f"w{k}".encode(), 5) for k in range(20)], 100)
    got = cm.context_tables(texts, lambda: code)
    once = cm.context_tables(texts.coalesce(1), lambda: code)
    assert (got == once).all() and got.sum() > 0


def test_empty_and_untrained(documents):
    assert cm.score_texts(documents()).count() == 0
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    got = cm.score_texts(documents(*((k, "some words") for k in held))).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(0, 0, 0.0, 0.0)] * 3


def test_the_word_before_last_is_a_context_and_thousands_of_words_have_paths(spark, documents):
    one, two, last = cm.contexts(np.array([5, 6, 9, 5, 7, 9, 4, 6, 9]), np.array([3, 3, 3]))
    assert last[2] == last[5] != last[8] and two[2] != two[5] and one[2] == one[8]
    assert last[0] == last[1] == last[3] == last[4] == last[6]
    rnd = random.Random(3)
    # A word at random stands between any two that go together; 3,000 words are about equally common.
    texts = []
    for k in range(400):
        at = [rnd.randrange(3000) for _ in range(40)]
        texts.append((k, " ".join(f"w{a} x{rnd.randrange(50)} v{a % 40}" for a in at)))
    got = [r for r in cm.score_texts(documents(*texts)).collect() if r.held_out]
    codes = cm.build_code([(f"w{k}".encode(), 5) for k in range(cm.TOP_WORDS)], 10)
    assert len(codes.number) >= 4095 and cm.OWN_SLOTS >= len(codes.ahead)
    assert sum(r.score for r in got) > 0.93 * sum(r.base_score for r in got)


def test_rows_without_id_spread_over_blocks(spark, monkeypatch):
    """Blocks are dealt by id and text, and a score does not depend on its block."""
    texts = [f"a{k % 7} b{k % 5} c{k}" for k in range(300)]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    whole = sorted(r.score for r in cm.score_texts(df).collect())
    monkeypatch.setattr(cm, "BLOCK_BYTES", 300)
    parts = sorted(r.score for r in cm.score_texts(df).collect())
    assert len(parts) == 300 and parts == pytest.approx(whole, rel=1e-4)


def _by_bits(mixer, seen, lengths, rate, leave_out, common):
    """``Mixer.bits_of`` for one event after another."""
    code, weights, out = mixer.code, {}, np.zeros(len(lengths))
    hashes, starts = cm.contexts(seen[:, 1], lengths), np.cumsum(lengths) - lengths
    chance = 1 / (1 + np.exp(-code.ahead))
    own, mask = Counter(), (1 << 64) - 1
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    for at in range(0, max(lengths), cm.STEPS):
        taught, shown = [], []
        for text in order:
            for spot in range(starts[text] + at, starts[text] + min(lengths[text], at + cm.STEPS)):
                for place in range(code.first[seen[spot, 0]], code.first[seen[spot, 0] + 1]):
                    node, bit = int(code.nodes[place]), int(code.bits[place])
                    x, level = [float(np.clip(code.ahead[node], -8, 8))], 0
                    for k in range(cm.CONTEXTS):
                        mixed = (int(hashes[k, spot]) + (node << 32)) * 0x9E3779B97F4A7C15 & mask
                        slot = (mixed ^ mixed >> 29) >> 20 & (1 << cm.TABLE_BITS) - 1
                        counts = [int(n) for n in mixer.tables[k][slot]]
                        if leave_out:
                            counts[bit] = max(counts[bit] - 1, 0)
                        x.append(math.log((counts[1] + 0.7 * chance[node]) / (counts[0] + 0.7 * (1 - chance[node]))))
                        if k == 1:
                            level = sum(sum(counts) > limit for limit in (0.5, 1.5, 6.5))
                    x.append(math.log((own[text, node, 1] + 2 * chance[node]) / (own[text, node, 0] + 2 * (1 - chance[node]))))
                    x = [min(max(value, -8), 8) for value in x] + [0.3]
                    gate = int(code.depth[place]) * cm.SEEN + level
                    held = weights.setdefault((None if common else text, gate), np.array(mixer.weights[gate]))
                    missed = math.exp(-float(np.clip(held @ x, -20, 20)) * (1 if bit else -1))
                    out[text] += math.log2(1 + missed)
                    taught.append((held, rate * (1 if bit else -1) * missed / (1 + missed) * np.array(x)))
                    shown.append((text, node, bit))
        for held, change in taught:
            held += change
        own.update(shown)
    return out, {gate: held for (_, gate), held in weights.items()}


@pytest.mark.parametrize("leave_out", [False, True])
@pytest.mark.parametrize("tokens_at_once", [1, 70, 1 << 12])
def test_bits_equal_those_of_one_event_after_another(leave_out, tokens_at_once, monkeypatch):
    monkeypatch.setattr(cm, "INPUT_TOKENS", tokens_at_once)
    rnd = np.random.default_rng(4)
    code = cm.build_code([(f"t{k}".encode(), int(c)) for k, c in enumerate(rnd.integers(1, 90, 30))], 20)
    tables = rnd.integers(0, 9, (cm.CONTEXTS, 1 << cm.TABLE_BITS, 2)).astype("u4")
    mixer = cm.Mixer(code, tables, cm.first_weights())
    texts = [b" ".join(b"t%d" % k for k in rnd.integers(0, 33, n)) for n in (60, 0, 24, 23, 100, 3)]
    seen, lengths = cm.HashedWords(code).look(texts)
    expected, weights = _by_bits(mixer, seen, lengths, 0.02, leave_out, common=leave_out)
    got = mixer.bits_of(seen, lengths, 0.02, leave_out=leave_out, common=leave_out)
    assert got == pytest.approx(expected, rel=1e-5)
    if leave_out:
        assert all(mixer.weights[gate] == pytest.approx(held, abs=1e-5) for gate, held in weights.items())


def test_fit_looks_up_no_word_by_itself(monkeypatch):
    """The fit reads whole texts at once; it met every word as an object of its own before."""
    code = cm.build_code([(b"the", 9), (b"", 7), (b"x", 2)], 30)
    tables = np.zeros((cm.CONTEXTS, 1 << cm.TABLE_BITS, 2), "u4")
    monkeypatch.setattr(cm, "Words", None)
    batch = pa.RecordBatch.from_pydict({"text": ["The x y", "", "X the the"]})
    (row,) = (r for b in cm._fit_weights(lambda: (code, tables))(iter([batch])) for r in b.to_pylist())
    assert row["n"] == 9 and len(row["weights"]) == 8 * cm.DEPTHS * cm.SEEN * cm.INPUTS


ODD = [b"The x  unknown \xc3\xa9\xc2\x85 the", b"", b" \n", b"x" * 300 + b" THE", b"a b\x0bc\td\x1ce ", b"", b"\r\r"]


@pytest.mark.parametrize("piece", [1, 5, 1 << 20])
def test_texts_cut_in_arrow_have_the_words_of_texts_cut_one_by_one(piece, monkeypatch):
    monkeypatch.setattr(cm, "PIECE_BYTES", piece)
    words, lengths = cm.spell_out(ODD)
    plain = [[*t.lower().split(), b""] for t in ODD]
    assert words.to_pylist() == [w for t in plain for w in t] and lengths.tolist() == [len(t) for t in plain]
    met, ids = cm.distinct_words(words)
    assert len(set(met.to_pylist())) == len(met) and met.take(pa.array(ids)).to_pylist() == words.to_pylist()
    assert cm.spell_out([])[0].to_pylist() == [] and len(cm.distinct_words(cm.spell_out([])[0])[0]) == 0


def test_blocks_are_counted_without_an_object_per_word(monkeypatch):
    """Every word of a block was met as an object of its own before, for its counts and for its scores."""
    for name in ("cut", "tokens"):
        monkeypatch.setattr(cm, name, None, raising=False)
    held = [k % 3 == 1 for k in range(len(ODD))]
    docs = pa.table({"block": pa.array([4] * len(ODD), pa.int32()), "text": pa.array([t.decode() for t in ODD]), "held_out": held})
    expected = Counter()
    for text, h in zip(ODD, held):
        for word in [*text.lower().split(), b""]:
            expected[word] += not h
    got = cm._block_words(docs)
    assert dict(zip(got["word"].to_pylist(), got["n"].to_pylist())) == dict(expected) and len(got) == len(expected)
    assert set(got["block"].to_pylist()) == {4}
    code = cm.build_code([(b"the", 3), (b"", 7)], 30)
    tables = np.zeros((cm.CONTEXTS, 1 << cm.TABLE_BITS, 2), "f4")
    run = cm._score_block(lambda: (cm.Mixer(code, tables, cm.first_weights()), 30.0), 40, 9, "doc_id", pa.int64())
    known = got.filter(pc.greater(got["n"], 0)).select(["word", "n"]).rename_columns(["word", "c"])
    out = run(docs.append_column("doc_id", pa.array(range(len(ODD)))), known)
    count = lambda text: [expected[w] for w in [*text.lower().split(), b""]]
    assert out["doc_id"].to_pylist() == [*range(len(ODD))]
    assert out["n_known"].to_pylist() == [sum(c > 0 for c in count(t)) for t in ODD]
    assert out["base_score"].to_pylist() == pytest.approx([sum(math.log10((c + 0.5) / 45) for c in count(t)) for t in ODD])


def test_thousands_of_words_are_told_apart_at_once():
    code = cm.build_code([(b"w%d" % k, 9000 - k) for k in range(cm.TOP_WORDS)], 30)
    hashed = cm.HashedWords(code)
    texts = [b" ".join(b"w%d" % k for k in range(start, 6000, 7)) for start in range(7)]
    seen, _ = hashed.look(texts)
    assert hashed.most > 1 and (seen == cm.Words(code).look([w for t in texts for w in [*t.split(), b""]])[:, :2]).all()
    known = pa.table({"word": [b"w7", b"zz", b""], "c": [5, 6, 7]})
    assert cm.Words(code, known).look([b"", b"w7", b"w8", b"zz", b"w7"])[:, 2].tolist() == [7, 5, 0, 6, 5]


def test_slots_from_halves_are_those_of_whole_hashes():
    rnd = np.random.default_rng(8)
    spread, token = rnd.integers(0, 1 << 64, 50, "u8"), np.sort(rnd.integers(0, 50, 900))
    nodes = rnd.integers(0, cm.TOP_WORDS, 900)
    got = cm.slots(spread, token, cm.raised(nodes))
    whole = [(int(spread[t]) + (int(n) << 32) * 0x9E3779B97F4A7C15) % (1 << 64) for t, n in zip(token, nodes)]
    assert got.tolist() == [(h ^ h >> 29) >> 20 & (1 << cm.TABLE_BITS) - 1 for h in whole]


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_weights_refined_without_bits_are_the_same(few, monkeypatch):
    monkeypatch.setattr(cm, "FEW_EVENTS", few)
    rnd = np.random.default_rng(6)
    code = cm.build_code([(f"t{k}".encode(), int(c)) for k, c in enumerate(rnd.integers(1, 90, 30))], 20)
    tables = rnd.integers(0, 9, (cm.CONTEXTS, 1 << cm.TABLE_BITS, 2)).astype("f4")
    seen, lengths = cm.HashedWords(code).look([b" ".join(b"t%d" % k for k in rnd.integers(0, 33, n)) for n in (60, 0, 24, 200)])
    one, other = (cm.Mixer(code, tables, cm.first_weights()) for _ in range(2))
    one.refine(seen, lengths, 0.02)
    other.bits_of(seen, lengths, 0.02, leave_out=True, common=True)
    assert (one.weights == other.weights).all() and (one.weights != cm.first_weights()).any()
