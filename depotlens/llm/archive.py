"""Web archives in ZIP packages, written and read by ranges.

A package is a ZIP file whose members are stored as they are: ``archive/data.warc.gz``, a run
of gzip members with one WARC record each, ``indexes/index.cdx``, one line per record with
place and length, and ``datapackage.json``. Large packages and members use the ZIP64 fields.
The reader parses the end record, the ZIP64 end record where it is needed, and the central
directory, finds the start of stored members, and fetches records by range.

Of pages with equal payloads the one of largest id is written as ``response``, the others as
``revisit`` records that refer to it and have no payload.

Case table: a null html is an empty payload; a page without id is always a response and is
never referred to; repeated rows of the largest id are all responses; an empty table gives no
package; extra columns are left out."""

from __future__ import annotations

import base64
import gzip
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.llm.storage import file_size, put, read_range
from depotlens.llm.words import slices

RECORDS = "archive/data.warc.gz"
INDEX = "indexes/index.cdx"
DESCRIPTION = "datapackage.json"
READ_BYTES = 8_000_000
LEVEL = 6

# Fixed values of the ZIP format.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR, _DESCRIPTOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0x08074B50
_LOCAL_FORM = struct.Struct("<IHHHHHIIIHH")
_CENTRAL_FORM = struct.Struct("<IHHHHHHIIIHHHHHII")
_END_FORM = struct.Struct("<IHHHHIIH")
_END64_FORM = struct.Struct("<IQHHIIQQQQ")
_LOCATOR_FORM = struct.Struct("<IIQI")
_WIDE, _STREAMED = 0xFFFFFFFF, 0x0008
_DATE_1980 = 0x0021

# Fixed values of the WARC format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MOMENT = "2000-01-01T00:00:00Z"


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


class StoredZip:
    """Writes stored members one after another to a sink that can't go back: sizes follow
    each member in a ZIP64 descriptor, and the directory comes last."""

    def __init__(self, sink) -> None:
        self.sink, self.place, self.done = sink, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.place += len(data)

    def member(self, name: str, content: Iterator[bytes]) -> None:
        start, raw = self.place, name.encode()
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(_LOCAL_FORM.pack(_LOCAL, 45, _STREAMED, 0, 0, _DATE_1980, 0, _WIDE, _WIDE, len(raw), len(extra)) + raw + extra)
        size, check = 0, 0
        for data in content:
            self._put(data)
            size, check = size + len(data), zlib.crc32(data, check)
        self._put(struct.pack("<IIQQ", _DESCRIPTOR, check, size, size))
        self.done.append((raw, check, size, start))

    def close(self) -> None:
        begin = self.place
        for raw, check, size, start in self.done:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(_CENTRAL_FORM.pack(_CENTRAL, 45, 45, _STREAMED, 0, 0, _DATE_1980, check, _WIDE, _WIDE, len(raw), len(extra), 0, 0, 0, 0, _WIDE) + raw + extra)
        length, end = self.place - begin, self.place
        count = len(self.done)
        self._put(_END64_FORM.pack(_END64, _END64_FORM.size - 12, 45, 45, 0, 0, count, count, length, begin))
        self._put(_LOCATOR_FORM.pack(_LOCATOR, 0, end, 1))
        self._put(_END_FORM.pack(_END, 0, 0, 0xFFFF, 0xFFFF, _WIDE, _WIDE, 0))


def directory(uri: str) -> dict[str, Member]:
    """Members of a ZIP file by name, from its end and central directory."""
    size = file_size(uri)
    tail_start = max(0, size - _END_FORM.size - 0xFFFF - _LOCATOR_FORM.size)
    tail = read_range(uri, tail_start, size - tail_start)
    at = tail.rfind(struct.pack("<I", _END))
    if at < 0:
        raise ValueError(f"{uri} has no end record of a ZIP file")
    _, _, _, _, count, length, begin, _ = _END_FORM.unpack_from(tail, at)
    locator = at - _LOCATOR_FORM.size
    if locator >= 0 and tail[locator : locator + 4] == struct.pack("<I", _LOCATOR):
        _, _, end64, _ = _LOCATOR_FORM.unpack_from(tail, locator)
        fields = _END64_FORM.unpack(read_range(uri, end64, _END64_FORM.size))
        count, length, begin = fields[7:10]
    entries, found, at = read_range(uri, begin, length), {}, 0
    for _ in range(count):
        (magic, _, _, _, method, _, _, _, packed, plain, names, extras, comments, _, _, _, header) = _CENTRAL_FORM.unpack_from(entries, at)
        if magic != _CENTRAL:
            raise ValueError(f"{uri} has a broken central directory")
        at += _CENTRAL_FORM.size
        name = entries[at : at + names].decode()
        wide = _zip64(entries[at + names : at + names + extras])
        # the wide fields are present in this order, each only if its narrow one is full
        plain = wide.pop(0) if plain == _WIDE else plain
        packed = wide.pop(0) if packed == _WIDE else packed
        header = wide.pop(0) if header == _WIDE else header
        found[name] = Member(name, method, packed, header)
        at += names + extras + comments
    return found


def _zip64(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
        at += 4 + size
    return []


def content_start(uri: str, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed, not stored")
    fields = _LOCAL_FORM.unpack(read_range(uri, member.header, _LOCAL_FORM.size))
    if fields[0] != _LOCAL:
        raise ValueError(f"{uri} has no member at {member.header}")
    return member.header + _LOCAL_FORM.size + fields[9] + fields[10]


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _record(page: int | None, url: str | None, html: str | None, size: int, sha1: bytes, refers: int | None) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the HTTP header, which states the
    size of the full payload, and leaves the payload out."""
    payload = (html or "").encode() if refers is None else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    name = f"urn:page:{'' if page is None else page}"
    target = "".join(c for c in (url or "about:blank") if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {_MOMENT}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest_text(sha1)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    return gzip.compress(whole, LEVEL, mtime=0)


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of one record."""
    head, _, block = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = block[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``size``, ``sha1`` and ``refers``, the page a revisit
    refers to. Payloads are compared by digest and size; the largest id of each is found
    by an aggregate with one row per payload, so a payload that many pages share is
    combined before the shuffle, and the join back is split where it is skewed."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html",
        F.octet_length(html).cast("long").alias("size"), F.unhex(F.sha1(html)).alias("sha1"),
    )
    last = rows.groupBy("sha1", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
    shared = last.where("copies > 1").drop("copies")
    joined = rows.join(shared, ["sha1", "size"], "left")
    refers = F.when(F.col("page_id") < F.col("last"), F.col("last"))
    return joined.select("page_id", "url", "html", "size", "sha1", refers.alias("refers"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """One package per partition below ``folder``; returns the plan of the list of
    packages, which must be stored before use (the tasks that compute it write them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = (part for batch in batches for part in slices(batch, "html"))
        first = next(source, None)
        if first is None:
            return
        uri = f"{folder}/pages-{TaskContext.get().partitionId():06d}.wacz"
        index: list[bytes] = []

        def records() -> Iterator[bytes]:
            part, place = first, 0
            while part is not None:
                for row in part.to_pylist():
                    record = _record(row["page_id"], row["url"], row["html"], row["size"], row["sha1"], row["refers"])
                    entry = {"page": row["page_id"], "offset": place, "length": len(record)}
                    index.append(json.dumps(entry).encode() + b"\n")
                    place += len(record)
                    yield record
                part = next(source, None)

        def fill(sink) -> None:
            package = StoredZip(sink)
            package.member(RECORDS, records())
            package.member(INDEX, iter(index))
            described = {"profile": "data-package", "resources": [{"path": RECORDS}, {"path": INDEX}]}
            package.member(DESCRIPTION, iter([json.dumps(described).encode()]))
            package.close()

        put(uri, uuid.uuid4().hex, fill)
        yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(index)], pa.int64())], names=["file", "records"])

    return with_roles(pages).mapInArrow(run, "file string, records bigint")


@dataclass
class Package:
    """A package opened by its directory; records are read on request."""

    uri: str
    start: int
    entries: list[dict]

    @classmethod
    def open(cls, uri: str) -> Package:
        members = directory(uri)
        index = members[INDEX]
        lines = read_range(uri, content_start(uri, index), index.size).splitlines()
        return cls(uri, content_start(uri, members[RECORDS]), [json.loads(line) for line in lines])

    def records(self, first: int, last: int) -> list[bytes]:
        """Unpacked records ``first`` to ``last - 1``, by one read."""
        place = self.entries[first]["offset"]
        length = self.entries[last - 1]["offset"] + self.entries[last - 1]["length"] - place
        data = read_range(self.uri, self.start + place, length)
        return [gzip.decompress(data[e["offset"] - place : e["offset"] - place + e["length"]]) for e in self.entries[first:last]]

    def find(self, page: int) -> list[bytes]:
        return [self.records(k, k + 1)[0] for k, e in enumerate(self.entries) if e["page"] == page]

    def runs(self, most: int = READ_BYTES) -> Iterator[tuple[int, int]]:
        first = total = 0
        for k, entry in enumerate(self.entries):
            if k > first and total + entry["length"] > most:
                yield first, k
                first, total = k, 0
            total += entry["length"]
        if self.entries:
            yield first, len(self.entries)


def _page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read(packages: DataFrame) -> DataFrame:
    """Every record of a stored list of packages: ``page_id``, ``url``, ``payload`` (null
    for revisits), size and digest of the full payload, type, and the page referred to.
    The digest of a response is computed from the payload and compared with the stated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for uri in batch.column("file").to_pylist():
                package = Package.open(uri)
                for first, last in package.runs():
                    rows = []
                    for data in package.records(first, last):
                        warc, http, payload = parsed(data)
                        kind, size = warc["warc-type"], int(http["content-length"])
                        digest = warc["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != size or digest_text(hashlib.sha1(payload).digest()) != digest):
                            raise ValueError(f"a record of {uri} does not match its digest")
                        rows.append({
                            "page_id": _page_of(warc["warc-record-id"]),
                            "url": warc["warc-target-uri"],
                            "payload": payload if kind == "response" else None,
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": kind,
                            "refers_to": _page_of(warc["warc-refers-to"]) if kind == "revisit" else None,
                        })
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)

    count = packages.count()
    return packages.select("file").repartition(max(1, count)).mapInArrow(
        run,
        "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string,"
        " record_type string, refers_to bigint",
    )


_ROWS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])
