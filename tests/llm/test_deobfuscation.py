import hashlib
import random
import re
import time

import pytest

from orderloom.llm import deobfuscation as pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    """The contract's patterns as they stand."""
    spans = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for i, d in enumerate(digits[::-1]))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, m.end()))
    return sorted(spans)


def listed(spans):
    return ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in spans)


def made_texts(seed, n):
    rnd = random.Random(seed)
    parts = [
        "a.b", "@", "x-y.com", ".", "1.2.3.4", "255", "256", "0", "00012", "4785380592391139", "4785 3805-9239 1139", " ", "-", "+1",
        "(017) 555-7713", "é", "😀", "\n", "%+", "()", "12", "7", "@@", "..", "+", "at", "dot",
    ]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)]


def test_base_spans_equal_the_patterns(spark, documents, folder):
    rows = [*enumerate(made_texts(5, 1500)), (9000, None), (9001, ""), (9001, ""), (None, "mail a@b.cd"), (9002, "1" * 3_000 + " a@b.c")]
    df = documents(*rows).selectExpr("*", "'x' as id", "1 as found", "2 as spans")
    got = pii.op12_personal_data(spark, folder(documents=df)).collect()
    expected = []
    for key, text in rows:
        spans = plain_base(text or "")
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        expected.append((key, *counts, hashlib.sha256(listed(spans).encode()).hexdigest()))
    texts = dict(rows)
    shown = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got]
    assert sorted(shown, key=str) == sorted(expected, key=str)
    for r in got:
        spans = set(filter(None, r.spans.split(",")))
        assert {s for s in listed(plain_base(texts[r.doc_id] or "")).split(",") if s} <= spans and r.n_spans == len(spans)


def added(text):
    return [(pii.KINDS[k], text[a:b], value) for a, k, b, base, value in pii.spans_of(text) if not base]


@pytest.mark.parametrize(
    ("text", "kind", "source", "value"),
    [
        ("write john [at] example [dot] com now", "email", "john [at] example [dot] com", "john@example.com"),
        ("mail john.doe(at)mail.example(dot)org!", "email", "john.doe(at)mail.example(dot)org", "john.doe@mail.example.org"),
        ("to ann dot lee at example dot co dot uk please", "email", "ann dot lee at example dot co dot uk", "ann.lee@example.co.uk"),
        ("escribe a ana arroba correo punto es, gracias", "email", "ana arroba correo punto es", "ana@correo.es"),
        ("see jоhn@exаmple.com", "email", "jоhn@exаmple.com", "john@example.com"),
        ("née ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ fin", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "john@example.com"),
        ("jo​hn​@exam­ple.com", "email", "jo​hn​@exam­ple.com", "john@example.com"),
        ("host 192[.]168[.]1[.]20 up", "ip", "192[.]168[.]1[.]20", "192.168.1.20"),
        ("host one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one", "192.168.0.1"),
        ("٤٧٨٥٣٨٠٥٩٢٣٩١١٣٩ ist es", "card", "٤٧٨٥٣٨٠٥٩٢٣٩١١٣٩", "4785380592391139"),
        ("4785–3805–9239–1139", "card", "4785–3805–9239–1139", "4785-3805-9239-1139"),
        ("four seven eight five three eight zero five nine two three nine one one three nine.", "card",
         "four seven eight five three eight zero five nine two three nine one one three nine", "4785380592391139"),
        ("ring plus four nine three zero one two three four five six seven eight", "phone",
         "plus four nine three zero one two three four five six seven eight", "+493012345678"),
        ("ring +1 (two-zero-two) 555-0143 x", "phone", "+1 (two-zero-two) 555-0143", "+1 (202) 555-0143"),
    ],
)
def test_disguises_are_found_where_they_stand(text, kind, source, value):
    assert (kind, source, value) in added(text)
    for prefix in ("", "é😀 \u200b", "Ａ"):
        assert source in [s for k, s, _ in added(f"{prefix} {text}") if k == kind]


@pytest.mark.parametrize("text", [
    "We meet at noon, dot by dot.", "look at example.com", "one two three four", "null und acht", "a point at issue", "six at one dot",
    "version 1.2.3 at 10.5", "Ελλάδα и Россия", "un punto a favor", "tel plus one", "mail a@b.cd and 10.0.0.1",
])
def test_plain_prose_adds_nothing(text):
    assert added(text) == []


def test_one_character_look_alikes_equal_a_plain_pass():
    rnd = random.Random(3)
    swap = {plain: odd for odd, plain in pii.LOOK_ALIKE.items() if plain.isalpha()}
    for _ in range(200):
        local = "".join(rnd.choice("acepxyosi") for _ in range(6))
        text = "".join(swap[c] if c in swap and rnd.random() < 0.4 else c for c in local) + "@" + rnd.choice(["exаmple.org", "example.org"])
        padded = "ü " * rnd.randint(0, 5)
        whole = [(s, e) for s, k, e, *_ in pii.spans_of(padded + text) if k == 0]
        assert (len(padded), len(padded) + len(text)) in whole


def test_long_texts_take_linear_time():
    for unit in ("a", "1", "1.", "+1 ", "@", "a@", "one ", "1 ", "(", "[at]", "- ", " dot", "+(", "one-", "é", "а"):
        started = time.perf_counter()
        pii.spans_of(unit * (400_000 // len(unit)))
        assert time.perf_counter() - started < 8, unit


def test_masking_keeps_other_columns(spark):
    rows = [(1, "mail a@b.cd or a (at) b (dot) cd", "s"), (2, None, None), (3, "", "t")]
    df = spark.createDataFrame(rows, "id int, text string, spans string")
    assert [tuple(r) for r in pii.masked(df).orderBy("id").collect()] == [(1, "mail [EMAIL] or [EMAIL]", "s"), (2, None, None), (3, "", "t")]


def test_empty_table(documents):
    assert pii.find_personal_data(documents()).count() == 0 and pii.masked(documents()).count() == 0
