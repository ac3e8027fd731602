"""WARC archives as a Spark data source, and archiving of pages with revisit records.

Reading plans one partition per range of files. A record's headers are parsed first; record
types and headers the query filters on are compared there, and the payload of a record that is
not wanted, or not asked for, is passed over by its length without being read or decoded.

Records are gzip members of their own, as WARC files have them, with the format's skip-length
field in front: an unwanted record is inflated up to its last header and then passed over. Plain
files and members without that field are read as well, front to back with memory for one record.
Files are opened through ``pyarrow.fs``, so any store it knows will do.

Defined cases: null html is an empty payload; equal payloads, empty ones among them, have one
response, the row with the smallest page id (null last, the first row of ties), and revisits; a
repeated row has a record of its own, with an id of its own; page ids may be of any type; an empty table writes no record and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from orderloom.llm.common import map_rows, table, text_of
from orderloom.session import scratch_path

#: Columns the reader can compare while only a record's headers are known.
HEADER_COLUMNS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
SCHEMA = (
    "record_id string, record_type string, target_uri string, record_date string, payload_digest string, "
    "payload_length bigint, refers_to string, payload binary"
)
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
# Revisits carry no payload, so its length travels in a header of our own.
LENGTH_HEADER = "Orderloom-Payload-Length"
BLOCK_BYTES = 1 << 20


def _filesystem(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.LocalFileSystem(), path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_text(value: str) -> str:
    """A header value on one line; white space that would end it becomes a plain space."""
    return " ".join(value.split())


def record_bytes(row: dict) -> bytes:
    """One record: its headers, an HTTP block, and the payload unless it is a revisit."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"] or b""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    headers = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Date", row["record_date"]),
        ("WARC-Payload-Digest", row["payload_digest"] and f"sha1:{row['payload_digest']}"),
        (LENGTH_HEADER, str(row["payload_length"])),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = [VERSION, *(f"{k}: {_header_text(v)}".encode() for k, v in headers if v is not None)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 1) -> bytes:
    """``record`` as one gzip member whose extra field tells the lengths before and after."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    total = 24 + len(body) + len(tail)
    if max(total, len(record)) >= 1 << 32:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(record))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class _Stream:
    """Buffered reading that can pass over bytes without keeping them."""

    def __init__(self, file):
        self.file, self.held, self.at = file, b"", 0

    def more(self) -> bool:
        new = self.file.read(BLOCK_BYTES)
        self.held, self.at = self.held[self.at :] + new, 0
        return bool(new)

    def peek(self, size: int) -> bytes:
        while len(self.held) - self.at < size and self.more():
            pass
        return self.held[self.at : self.at + size]

    def line(self) -> bytes:
        looked = self.at
        while (end := self.held.find(b"\n", looked)) < 0:
            looked = len(self.held) - self.at
            if not self.more():
                rest, self.held, self.at = self.held, b"", 0
                return rest
        found = self.held[self.at : end + 1]
        self.at = end + 1
        return found

    def take(self, size: int) -> bytes:
        found = self.held[self.at : self.at + size]
        self.at += len(found)
        parts = [found]
        missing = size - len(found)
        while missing:
            more = self.file.read(missing)
            if not more:
                raise EOFError("A WARC record ends before its stated length.")
            parts.append(more)
            missing -= len(more)
        return b"".join(parts)

    def skip(self, size: int) -> None:
        kept = min(size, len(self.held) - self.at)
        self.at += kept
        if size > kept:
            self.file.seek(self.file.tell() + size - kept)

    def end(self) -> None:
        """Nothing to do after a plain record: blank lines are passed over before the next."""


class _Member(_Stream):
    """The inflated bytes of the gzip member at the front of ``outer``."""

    def __init__(self, outer: _Stream):
        super().__init__(None)
        self.outer, self.inflater, self.left = outer, zlib.decompressobj(-15), None
        head = outer.take(10)
        flags, used = head[3], 10
        if flags & 4:
            size = struct.unpack("<H", outer.take(2))[0]
            extra, used = outer.take(size), used + 2 + size
            if extra[:4] == b"sl\x08\0":
                self.left = struct.unpack("<I", extra[4:8])[0] - used
        for bit in (8, 16):
            while flags & bit and outer.take(1) != b"\0":
                self.left = None
        if flags & 2:
            outer.take(2)

    def more(self) -> bool:
        if self.inflater.eof:
            return False
        if not self.outer.peek(1):
            raise EOFError("A WARC record ends before its stated length.")
        given = self.outer.held[self.outer.at : self.outer.at + (1 << 14)]
        new = self.inflater.decompress(given)
        used = len(given) - len(self.inflater.unused_data)
        self.outer.at += used
        if self.left is not None:
            self.left -= used
        self.held, self.at = self.held[self.at :] + new, 0
        return True

    def take(self, size: int) -> bytes:
        parts, missing = [], size
        while missing:
            found = self.held[self.at : self.at + missing]
            self.at += len(found)
            missing -= len(found)
            parts.append(found)
            if missing and not self.more():
                raise EOFError("A WARC record ends before its stated length.")
        return b"".join(parts)

    def skip(self, size: int) -> None:
        """Left to ``end``, which need not inflate."""

    def end(self) -> None:
        if self.left is not None:
            self.outer.skip(self.left)
            return
        while not self.inflater.eof:
            self.held, self.at = b"", 0
            self.more()
        self.outer.take(8)


def read_records(file, wanted=lambda headers: True, payloads: bool = True) -> Iterator[tuple[dict, bytes | None]]:
    """Headers and payload of each wanted record, in file order; names keep their case."""
    whole = _Stream(file)
    while start := whole.peek(2):
        stream = _Member(whole) if start == b"\x1f\x8b" else whole
        line = stream.line()
        if not line.strip():
            stream.end()
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"No WARC record starts with {line[:40]!r}.")
        headers: dict[str, str] = {}
        while (line := stream.line()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        size = int(headers["Content-Length"])
        if not wanted(headers) or not payloads:
            found = wanted(headers)
            stream.skip(size)
            stream.end()
            if found:
                yield headers, None
            continue
        block = stream.take(size)
        stream.end()
        http = headers.get("Content-Type", "").startswith("application/http")
        cut = block.find(b"\r\n\r\n") if http else -4
        yield headers, block[cut + 4 :] if cut >= 0 or not http else b""


@dataclass
class _Files(InputPartition):
    paths: tuple[str, ...]

    def __init__(self, paths: Sequence[str]):
        self.paths = tuple(paths)


@dataclass
class _Written(WriterCommitMessage):
    path: str | None
    records: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.files_per_partition = int(options.get("filespertask", "1"))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Take equality and membership on header columns; give the rest back to Spark."""
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name in HEADER_COLUMNS:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, root = _filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        paths = sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith((".warc", ".warc.gz")))
        step = self.files_per_partition
        return [_Files(paths[k : k + step]) for k in range(0, len(paths), step)] or [_Files(())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        system, _ = _filesystem(self.path)

        def wanted(headers):
            return all(_column(headers, name) in values for name, values in self.wanted.items())

        for path in partition.paths:
            with system.open_input_file(path) as file:
                for headers, payload in read_records(file, wanted, self.payloads):
                    length = headers.get(LENGTH_HEADER)
                    if length is None and payload is not None:
                        length = len(payload)
                    yield (
                        *(_column(headers, n) for n in ("record_id", "record_type", "target_uri")),
                        headers.get("WARC-Date"),
                        _column(headers, "payload_digest"),
                        None if length is None else int(length),
                        _column(headers, "refers_to"),
                        payload,
                    )


def _column(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADER_COLUMNS[name])
    return value.removeprefix("sha1:") if value and name == "payload_digest" else value


class WarcWriter(DataSourceWriter):
    """One file per task. Only files named in a commit get a name that readers take.

    A task that fails removes its file; one whose executor is lost leaves a file ending in ``.open``.
    """

    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names = options["path"], names

    def write(self, iterator) -> WriterCommitMessage:
        system, root = _filesystem(self.path)
        system.create_dir(root, recursive=True)
        path, records, out = f"{root}/part-{uuid.uuid4().hex}.warc.gz.open", 0, None
        try:
            for row in iterator:
                if out is None:
                    out = system.open_output_stream(path)
                out.write(gzip_member(record_bytes(dict(zip(self.names, row)))))
                records += 1
        except BaseException:
            if out is not None:
                out.close()
                out = None
                system.delete_file(path)
            raise
        finally:
            if out is not None:
                out.close()
        return _Written(path if records else None, records)

    def commit(self, messages) -> None:
        system, _ = _filesystem(self.path)
        for m in messages:
            if m is not None and m.path:
                system.move(m.path, m.path.removesuffix(".open"))

    def abort(self, messages) -> None:
        system, _ = _filesystem(self.path)
        for m in messages:
            if m is not None and m.path:
                system.delete_file(m.path)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; option ``payload=false`` leaves payloads unread."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("WARC folders are only appended to.")
        return WarcWriter(self.options, schema.names)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """The records of ``page_id, url, html`` rows; equal payloads from that size on have one response.

    The response is the row of the smallest page id, null last, and among rows with that id the first
    in ``pages``, which must give its rows in the same places when it is read twice, as files do. Record
    ids name page and row, so repeated rows have records of their own.

    Only digests, ids and places are grouped: a payload that a third of the pages share is one row per
    task before the shuffle, and the join that follows can split its hot side.
    """

    def digests(columns):
        payloads = [h.encode() for h in columns["html"]]
        return columns | {
            "payload": payloads,
            "payload_digest": [payload_digest(p) for p in payloads],
            "payload_length": [len(p) for p in payloads],
        }

    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"),
        F.monotonically_increasing_id().alias("place"),
    )
    kind = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, place bigint, payload binary, payload_digest string, payload_length bigint"
    # Digests are cheaper to compute twice than payloads are to write once more.
    digested = map_rows(rows, digests, schema, rows=500)
    name = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "place")
    first = digested.groupBy("payload_digest").agg(F.min(name).alias("first"))
    joined = digested.join(first, "payload_digest")
    response = (F.col("payload_length") < min_revisit_bytes) | (F.col("place") == F.col("first.place"))
    return joined.select(
        _urn("page_id", "place").alias("record_id"),
        F.when(response, "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("record_date"),
        "payload_digest",
        "payload_length",
        F.when(~response, _urn("first.page_id", "first.place")).alias("refers_to"),
        F.when(response, F.col("payload")).alias("payload"),
    )


def _urn(page: str, place: str) -> Column:
    """A record's id from its page id, escaped (null: ``~``, which escaping never leaves), and its row's place."""
    named = F.coalesce(F.url_encode(F.col(page).cast("string")), F.lit("~"))
    return F.concat(F.lit("<urn:orderloom:page:"), named, F.lit(":"), F.col(place).cast("string"), F.lit(">"))


def write_archive(records: DataFrame, path: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def page_of(record_id: str, kind: str) -> Column:
    """The page id, of type ``kind``, that a record's id names."""
    named = F.regexp_extract(record_id, r"page:([^:>]+):\d+>", 1)
    return F.when(named.isin("", "~"), None).otherwise(F.url_decode(named)).cast(kind)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page's record, then read the archives back by record type.

    Responses are read with their payload, whose digest is computed again and must equal the
    header's; revisits are read from their headers alone.
    """
    path, pages = scratch_path(spark, "warc"), table(spark, sf_dir, "pages")
    write_archive(page_records(pages), path)
    kind = pages.schema["page_id"].dataType.simpleString()

    def verify(columns):
        found = [payload_digest(p) for p in columns["payload"]]
        if found != columns["payload_digest"]:
            raise ValueError("A payload read back differs from its digest.")
        return {n: columns[n] for n in ("record_id", "payload_digest", "record_type", "refers_to")} | {
            "payload_length": [len(p) for p in columns["payload"]]
        }

    names = ("record_id", "payload_length", "payload_digest", "record_type", "refers_to")
    responses = map_rows(
        read_archive(spark, path).where("record_type = 'response'").select(*names, "payload"),
        verify,
        "record_id string, payload_length bigint, payload_digest string, record_type string, refers_to string",
        rows=500,
    )
    revisits = read_archive(spark, path, payload=False).where("record_type = 'revisit'").select(*names)
    return responses.unionByName(revisits).select(
        page_of("record_id", kind).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_of("refers_to", kind).alias("refers_to"),
    )


OP10_SQL = """
WITH digested AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes, hex,
         list_aggregate(list_transform(range(0, 8), lambda g:
           list_aggregate(list_transform(range(0, 4), lambda k:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + (('0x' || substr(hex, (g * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * k)::BIGINT) % 32, 1)
           ), 'string_agg', '')
         ), 'string_agg', '') AS payload_digest
  FROM digested
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place = 1 THEN NULL ELSE first_id END AS refers_to
FROM (SELECT *, row_number() OVER (PARTITION BY hex ORDER BY page_id NULLS LAST) AS place,
             min(page_id) OVER (PARTITION BY hex) AS first_id FROM named)
"""
