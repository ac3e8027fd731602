import hashlib
import random
import re

from orderloom.llm import secrets

ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def made_texts():
    rnd = random.Random(9)
    parts = [
        "password", "PassWd", "secret", "Token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "é😀", "\n", "ſecret=",
        "abcdef0123456789", "deadbeef" * 3, "AKIA" + "Z9" * 8, "AKIA", "AKIAAKIA12345", "shortval", "x.y-z/w=_+abc123", "K",
    ]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(300)]


def test_base_spans_equal_a_plain_pass(documents, folder, spark):
    rows = [*enumerate(made_texts()), (900, None), (901, ""), (901, ""), (902, "token=secret: abcdefghijklmnop"), (903, "a1" * 40_000)]
    got = secrets.op6_secrets(spark, folder(documents=documents(*rows))).collect()
    assert len(got) == len(rows)
    expected = []
    for key, text in rows:
        spans = plain_base(text or "")
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(3)]
        expected.append((key, *counts, hashlib.sha256(listed(spans).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == sorted(expected)
    for r in got:
        base = [s for s in r.spans.split(",") if s and not s.startswith("mixed")]
        assert ",".join(base) == listed(plain_base(dict(rows)[r.doc_id] or ""))


def test_many_matches_in_one_text(documents):
    words = [hashlib.md5(str(k).encode()).hexdigest() for k in range(40_000)]
    mixed = [f"Zz{k:06d}QqWwEeRrTtYyUu" for k in range(3_000)]
    text = " ".join(words) + " " + " ".join(f"{m} token={m}" for m in mixed) + "\U0001f600 " + words[0]
    got = secrets.find_secrets(documents((1, text))).first()
    expected = plain_base(text)
    assert (got.n_assign, got.n_hex) == (3_000, 40_001)
    assert got.base_sha256 == hashlib.sha256(listed(expected).encode()).hexdigest()
    own = [s for s in got.spans.split(",") if s.startswith("mixed")]
    assert own == [f"mixed:{m.start()}:{m.end()}" for m in re.finditer("(?<= )Zz[0-9A-Za-z]+", text)]


def test_own_spans_that_touch_base_spans_fall(documents):
    value = "aB3dE5gH7jK9mN1pQ4rS6tU8"
    text = f"{value}token={value} {value}AKIA{'Q7' * 8} x {value}"
    got = secrets.find_secrets(documents((1, text))).first()
    assert [s for s in got.spans.split(",") if s.startswith("mixed")] == [f"mixed:{len(text) - 24}:{len(text)}"]


def test_copied_examples_are_not_live(documents):
    example, own = "wJalrXUtnFEMIbPxRfiCY99", "q8ZtKe31LmVx7RpWc2Yb0Hs"
    rows = [(k, f"see {example} here", f"src{k}") for k in range(5)]
    rows += [(10, f"key {own} end", "src1"), (11, f"again {own}", "src1"), (12, "password=aaaaaaaaaaaaaa", "src2")]
    got = {r.doc_id: r for r in secrets.find_secrets(documents(*rows)).collect()}
    assert all(got[k].spans == "" for k in range(5))
    assert got[10].spans == got[10].live_spans == "mixed:4:27" and got[11].n_live == 1
    assert (got[12].n_assign, got[12].n_live, got[12].n_copied) == (1, 0, 1)


def test_redaction(documents):
    rows = [(1, "é token=abcdef0123456789ab, then AKIA" + "Q7" * 8 + " end"), (2, "clean"), (3, None), (4, "")]
    got = {r.doc_id: r.text for r in secrets.redact(documents(*rows)).collect()}
    assert got == {1: "é [REDACTED], then [REDACTED] end", 2: "clean", 3: None, 4: ""}


def test_redaction_keeps_columns_with_working_names(documents):
    text = "token=abcdef0123456789ab"
    df = documents((1, text), (2, "clean")).selectExpr("*", "'x' as spans", "7 as _row", "8 as _base", "9 as _mixed", "'o' as _owner", "1 as c0", "2 as hash")
    got = secrets.redact(df)
    assert got.columns == df.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert {k: tuple(rows[k][n] for n in ("text", "spans", "_row", "_base", "_mixed", "_owner", "c0", "hash")) for k in rows} == {
        1: ("[REDACTED]", "x", 7, 8, 9, "o", 1, 2), 2: ("clean", "x", 7, 8, 9, "o", 1, 2),
    }


def test_plan_is_native(documents):
    plan = secrets.find_secrets(documents((1, "token=abcdef0123456789ab")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_table(documents):
    assert secrets.find_secrets(documents()).count() == 0
    assert secrets.redact(documents()).count() == 0
