import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import codes, dates, hashing, text
from orderloom.operators import privacy

SALT = "s4lt"


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_strip_removes_every_kind_of_white_space(values):
    df = values("v", ("\t a b \r\n",), (" x　",), ("\x1cz\x1f",), (None,))
    assert one(df, text.strip(F.col("v"))) == ["a b", "x", "z", None]


def test_padding_never_truncates(values):
    df = values("v", ("7",), ("1234567",))
    assert one(df, codes.zero_pad(F.col("v"), 6)) == ["000007", "1234567"]


def test_numbers_past_their_width(spark):
    df = spark.createDataFrame([(1,), (1000,)], "n bigint")
    assert one(df, codes.numbered(F.lit("X-"), F.col("n"), 3)) == ["X-001", "X-1000"]


@pytest.mark.parametrize(
    "raw, sku",
    [
        ("1234567890", "012345-67890"),
        ("1234567890.0", "012345-67890"),
        (" 5 ", "000000-00005"),
        ("123456789012", "123456-789012"),
    ],
)
def test_sku_is_restored_from_a_number(values, raw, sku):
    assert one(values("v", (raw,)), codes.full_sku_from_number(F.col("v"))) == [sku]


def test_trailing_number_and_prefix(values):
    df = values("v", ("SKU-AB2-000012",), ("SKU-ab-1",), ("none",), (None,))
    assert one(df, codes.trailing_number(F.col("v"))) == [12, 1, None, None]
    assert one(df, codes.sku_code_prefix(F.col("v"))) == ["AB2", None, None, None]


def test_initials(values):
    df = values("v", ("small  ring line",), (" ",))
    assert one(df, codes.initials(F.col("v"))) == ["SRL", "X"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("61626", dt.date(2026, 6, 16)),
        ("061626", dt.date(2026, 6, 16)),
        ("061675", dt.date(1975, 6, 16)),
        ("010170", dt.date(1970, 1, 1)),
        ("123169", dt.date(2069, 12, 31)),
        ("23026", None),
        ("1234567", None),
        ("6162a", None),
        ("", None),
        (None, None),
    ],
)
def test_short_days(values, given, expected):
    assert one(values("v", (given,)), dates.checked_short_day(F.col("v"))) == [expected]


def test_eight_digit_days(values, spark):
    df = values("v", ("20260228",), ("20260230",), ("2026022",), ("2026/02/28",), (None,))
    assert one(df, dates.checked_day(F.col("v"))) == [dt.date(2026, 2, 28), None, None, None, None]
    numbers = spark.createDataFrame([(0,), (20260228,), (20260230,), (None,)], "n bigint")
    assert one(numbers, dates.day_or_unavailable(F.col("n"))) == [None, dt.date(2026, 2, 28), None, None]


def expected_pseudonym(value):
    if value is None:
        return None
    letters, number = "", 0
    while len(letters) < len(value):
        digest = hashlib.sha256(f"{value}{SALT}{number}".encode()).digest()
        letters += "".join("abcdefghijklmnopqrstuvwxyz0123456789"[byte % 36] for byte in digest)
        number += 1
    return letters[: len(value)]


def test_pseudonym_keeps_length_and_is_stable(values):
    cases = ["PO-1", "", "a" * 32, "b" * 33, "x" * 70, "é漢字", None]
    df = values("v", *((c,) for c in cases))
    assert one(privacy.salted(df, SALT), hashing.pseudonym(F.col("v"), F.col(privacy.SALT))) == [expected_pseudonym(c) for c in cases]


def test_salted_hash(values):
    df = values("v", ("a",), (None,))
    assert one(df, hashing.salted_hash(F.col("v"), F.lit(SALT))) == [hashlib.sha256(f"a{SALT}".encode()).hexdigest(), None]


@pytest.mark.parametrize("salt", [None, "", "  "])
def test_salt_is_required(spark, salt):
    with pytest.raises(ValueError, match="salt"):
        hashing.salt_column(spark.range(1), salt)


def test_fingerprint_text_per_type_and_null_token(spark):
    schema = T.StructType.fromDDL("d date, m decimal(18,4), b boolean, t string")
    df = spark.createDataFrame([(dt.date(2026, 1, 2), None, True, "x")], schema)
    wanted = hashlib.md5("20260102|\\N|true|x".encode()).hexdigest()
    assert one(df, hashing.row_fingerprint(schema, ["d", "m", "b", "t", "absent"])) == [wanted]


def test_fingerprint_tells_close_and_large_doubles_apart(spark):
    schema = T.StructType.fromDDL("x double")
    df = spark.createDataFrame([(1.00001,), (1.00002,), (1e300,), (None,)], schema)
    assert len(set(one(df, hashing.row_fingerprint(schema, ["x"])))) == 4


def test_null_tokens(values):
    df = values("v", ("NULL",), (" null ",), ("  ",), (" Null",), (" a ",))
    assert one(df, text.null_if_token(F.col("v"))) == [None, None, None, "Null", "a"]


def test_salt_is_in_no_plan_and_no_setting(values, capsys):
    df = privacy.salted(values("v", ("a",)), "top.secret")
    out = df.select(hashing.salted_hash(F.col("v"), F.col("_salt")), hashing.pseudonym(F.col("v"), F.col("_salt")))
    out.collect()
    out.explain(True)
    assert "secret" not in capsys.readouterr().out
    assert not [r for r in df.sparkSession.sql("SET").collect() if "secret" in str(r)]


def test_salt_may_come_from_a_table(values):
    table, given = values("s", ("pepper",)), values("v", ("a",))
    assert one(privacy.salted(given, table), F.col("_salt")) == ["pepper"]
    with pytest.raises(Exception, match="non-blank"):
        privacy.salted(given, values("s", (" ",))).collect()
