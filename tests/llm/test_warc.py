import base64
import gzip
import hashlib
import io
import random

import duckdb
import pytest

from orderloom.llm import warc

PAGES = "page_id bigint, url string, html string, payload_digest string"
ROWS = [
    (1, "http://a/1", "<p>é</p>", "clash"), (2, "http://a/2", "<p>é</p>", None), (3, None, None, None), (4, "u", "", None),
    (5, "u", "x" * 300_000, None), (6, "u", "a\r\n\r\nWARC/1.1\r\nb", None), (6, "u", "a\r\n\r\nWARC/1.1\r\nb", None),
    (7, "bad\r\nWARC-Type: x", "only", None), (None, "u", "<p>é</p>", None),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(ROWS, PAGES)


def test_query_equals_a_plain_pass(spark, pages, folder):
    first = {}
    for place, (key, _, html, _) in enumerate(ROWS):
        name = (key is None, key or 0, place)
        first[html or ""] = min(first.get(html or "", name), name)
    expected = []
    for place, (key, _, html, _) in enumerate(ROWS):
        text = html or ""
        _, least, chosen = first[text]
        same = place == chosen
        expected.append((key, len(text.encode()), digest(text), "response" if same else "revisit", None if same else least))
    got = warc.op10_warc(spark, folder(pages=pages)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_repeated_rows_have_one_response_and_ids_of_their_own(spark, folder):
    rows = [(1, "u", "a", None), (1, "u", "a", None), (None, "u", "b", None), (None, "u", "b", None), (None, "v", "b", None)]
    pages = spark.createDataFrame(rows, PAGES)
    records = warc.page_records(pages).collect()
    assert len({r.record_id for r in records}) == len(rows)
    responses = {r.record_id: r.payload_digest for r in records if r.record_type == "response"}
    assert sorted(responses.values()) == sorted([digest("a"), digest("b")])
    assert all(responses[r.refers_to] == r.payload_digest for r in records if r.record_type == "revisit")
    got = warc.op10_warc(spark, folder(pages=pages))
    connection = duckdb.connect()
    connection.execute(f"create view pages as select * from '{folder(pages=pages)}/pages.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, connection.execute(warc.OP10_SQL).fetchall()))


def test_page_ids_of_any_kind_come_back(spark, folder):
    rows = [("a:b>", "u", "x"), ("~", "u", "x"), ("é 1", "u", "y"), (None, "u", "y")]
    got = warc.op10_warc(spark, folder(pages=spark.createDataFrame(rows, "page_id string, url string, html string")))
    assert {(r.page_id, r.record_type, r.refers_to) for r in got.collect()} == {
        ("a:b>", "response", None), ("~", "revisit", "a:b>"), ("é 1", "response", None), (None, "revisit", "é 1"),
    }


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    connection.execute("create view pages as select * from '/root/testdata/sf0.001/pages.parquet'")
    got = warc.op10_warc(spark, "/root/testdata/sf0.001")
    expected = connection.execute(warc.OP10_SQL).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_empty_table(spark, pages, folder):
    assert warc.op10_warc(spark, folder(pages=pages.limit(0))).count() == 0


def test_filters_are_taken_and_payloads_passed_over(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(warc.page_records(pages), path)
    df = warc.read_archive(spark, path).where("record_type = 'response' and target_uri in ('http://a/1', 'u')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if x.lstrip("+-: *(0123456789)").startswith("Filter") and "response" in x]
    assert {r.record_type for r in df.collect()} == {"response"}
    bare = warc.read_archive(spark, path, payload=False)
    assert bare.where("payload is not null").count() == 0 and bare.count() == len(ROWS)


def test_unwanted_payloads_are_not_read():
    class Counting(io.BytesIO):
        bytes_read = 0

        def read(self, size=-1):
            found = super().read(size)
            Counting.bytes_read += len(found)
            return found

    row = {"record_id": "<urn:a>", "target_uri": "u", "record_date": "d", "payload_digest": "X", "payload_length": 1, "refers_to": None}
    big = random.Random(1).randbytes(9_000_000)
    records = [warc.record_bytes(row | {"record_type": t, "payload": big}) for t in ("resource", "response", "resource")]
    for pack in (bytes, warc.gzip_member):
        Counting.bytes_read = 0
        found = list(warc.read_records(Counting(b"".join(map(pack, records))), lambda h: h["WARC-Type"] == "response"))
        assert [p for _, p in found] == [big]
        assert Counting.bytes_read < 14_000_000


def test_other_gzip_writers_are_read():
    row = {"record_type": "response", "record_id": "a", "target_uri": "u", "record_date": "d", "payload_digest": "X",
           "payload_length": 3, "refers_to": None}
    records = [warc.record_bytes(row | {"payload": bytes([65 + k]) * (k * 50_000)}) for k in range(4)]
    mixed = b"".join([gzip.compress(records[0]), warc.gzip_member(records[1]), records[2], gzip.compress(records[3])])
    assert [len(p) for _, p in warc.read_records(io.BytesIO(mixed))] == [0, 50_000, 100_000, 150_000]
    assert len(list(warc.read_records(io.BytesIO(mixed), payloads=False))) == 4


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"no record\r\n\r\n")))
    whole = warc.record_bytes(
        {"record_type": "response", "record_id": "a", "target_uri": "u", "record_date": "d", "payload_digest": "X",
         "payload_length": 3, "refers_to": None, "payload": b"abc"}
    )
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(whole[:-6])))
