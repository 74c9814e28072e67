"""Legacy archive conversion: ARC files to WARC files.

An ARC file is a sequence of records: one header line of space-separated fields, then as many bytes as
its last field declares.  The first record is the version block; it names the version, and with it the
fields of the header lines (five in version 1, ten in version 2).  Every record becomes a WARC record
with a synthesised identifier, timestamp, type and digests.  Of records with equal payloads of at least
``REVISIT_BYTES`` the one with the largest page_id keeps its payload; the others revisit it.

Files are the units of work: each holds at most ``FILE_BYTES`` of content (one longer record fills a
file of its own), every record is a gzip member of its own, and a file is written by one task under a
name of its own, so a repeated task disturbs nothing.  Which record is kept is decided on
(digest, place) rows, folded before the shuffle and joined back; payloads are never shuffled.

Defined results: a null html is an empty payload, a null url is written as ``-``; white space and control
characters in a url are percent-encoded.  Of equal payloads with one page_id (repeated rows) the first
by place is kept and the others revisit it; a row without a page_id is smaller than every id.  A record
whose header does not parse or whose length runs past the end of the file is an error that names the file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.frames import stage
from tickflow.session import work_path

REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
LEVEL = 6

# Header lines of the two versions, and of the records written.
FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
NAMES = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
"""The name space of identifiers made from addresses."""


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class _Reader:
    """The bytes of a file of gzip members (or of a plain file), read in pieces."""

    def __init__(self, uri: str) -> None:
        system, path = _system(uri)
        self._in = system.open_input_stream(path)
        self._held = bytearray()
        self._raw = b""
        self._unpack = None
        self._plain: bool | None = None
        self.uri = uri

    def _more(self) -> bool:
        raw = self._raw or self._in.read(1 << 20)
        self._raw = b""
        if not raw:
            return False
        if self._plain is None:
            self._plain = raw[:2] != b"\x1f\x8b"
        if self._plain:
            self._held += raw
            return True
        if self._unpack is None:
            self._unpack = zlib.decompressobj(31)
        self._held += self._unpack.decompress(raw)
        if self._unpack.eof:
            self._raw, self._unpack = self._unpack.unused_data, None
        return True

    def line(self) -> bytes | None:
        """Up to and without the line end; None at the end of the file."""
        at = 0
        while (found := self._held.find(b"\n", at)) < 0:
            at = len(self._held)
            if not self._more():
                if self._held:
                    raise ValueError(f"{self.uri}: the file ends inside a header")
                return None
        out = bytes(self._held[:found])
        del self._held[: found + 1]
        return out.rstrip(b"\r")

    def exactly(self, n: int) -> bytes:
        while len(self._held) < n:
            if not self._more():
                raise ValueError(f"{self.uri}: a record is shorter than its declared length")
        out = bytes(self._held[:n])
        del self._held[:n]
        return out


class _Writer:
    """Files of a folder, each closed when its content reaches the bound."""

    def __init__(self, folder: str, kind: str, head: Callable[[str], bytes]) -> None:
        self.folder, self.kind, self.head = folder, kind, head
        self.closed: list[str] = []
        self._out = None
        self._size = 0

    def place(self, size: int) -> str:
        """The file for a record of ``size`` bytes."""
        if self._out is not None and self._size + size > FILE_BYTES:
            self.close()
        if self._out is None:
            self.uri = f"{self.folder}/{uuid.uuid4().hex}.{self.kind}.gz"
            system, path = _system(self.uri)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            self._out = system.open_output_stream(path, compression=None)
            head = self.head(self.uri)
            self._out.write(_member(head))
            self._size = len(head)
        self._size += size
        return self.uri

    def write(self, raw: bytes) -> None:
        self._out.write(_member(raw))

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self.closed.append(self.uri)
            self._out = None


def arc_head(version: str) -> bytes:
    body = f"{version} 0 origin\n{NAMES[version]}\n".encode()
    lead = "filedesc://pages.arc 0.0.0.0 19960101000000 text/plain"
    more = " 200 - - 0 pages.arc" if version == "2" else ""
    return f"{lead}{more} {len(body)}\n".encode() + body + b"\n"


def _arc_record(page_id: int | None, url: str | None, html: str | None, version: str) -> bytes:
    payload = (html or "").encode()
    reply = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    reply += f"X-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    address = quote(url, safe="".join(map(chr, range(33, 127)))) if url else "-"
    more = " 200 - - 0 pages.arc" if version == "2" else ""
    # A moment of the twenty years from 1996 on, told by the id.
    date = time.strftime("%Y%m%d%H%M%S", time.gmtime(820454400 + _told(page_id) % (20 * 365 * 86400)))
    return f"{address} 0.0.0.0 {date} text/html{more} {len(reply)}\n".encode() + reply + b"\n"


def _told(page_id: int | None) -> int:
    return zlib.crc32(str(page_id).encode())


def write_arc(pages: DataFrame, folder: str, version: str = "1") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as ARC files; returns the files (path).

    ``version`` is "1", "2", or "both": then a hash of the id deals pages to files of either.
    """
    versions = ("1", "2") if version == "both" else (version,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [_Writer(folder, "arc", lambda _, v=v: arc_head(v)) for v in versions]
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                values = [x.as_py() for x in row]
                which = (_told(values[0]) >> 8) % len(versions)
                raw = _arc_record(*values, versions[which])
                files[which].place(len(raw))
                files[which].write(raw)
        for out in files:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([x for out in files for x in out.closed], pa.string())], names=["path"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "path string")


def arc_records(uri: str) -> Iterator[tuple[int, dict, bytes]]:
    """(number, header fields, content) of every record after the version block."""
    reader = _Reader(uri)
    head = reader.line()
    if head is None:
        return
    body = reader.exactly(int(head.rsplit(b" ", 1)[1]))
    version = body.split(b" ", 1)[0].decode()
    if not head.startswith(b"filedesc:") or version not in FIELDS:
        raise ValueError(f"{uri}: not an archive of a known version")
    names, number = FIELDS[version], 0
    while (line := reader.line()) is not None:
        if not line:  # between records
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        if len(parts) != len(names) or not parts[-1].isascii() or not parts[-1].isdigit():
            raise ValueError(f"{uri}: header line of record {number} has not the fields of version {version}")
        fields = dict(zip(names, parts, strict=True))
        yield number, fields, reader.exactly(int(fields["length"]))
        number += 1


def _reply(content: bytes) -> tuple[bytes, bytes, int | None]:
    """HTTP header, payload, and the page id the header carries."""
    head, end, payload = content.partition(b"\r\n\r\n")
    m = re.search(rb"(?m)^X-Page-Id: (-?\d+)\r?$", head)
    return head + end, payload, int(m[1]) if m else None


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for number, _, content in arc_records(path):
                _, payload, page_id = _reply(content)
                rows.append((path, number, page_id, len(payload), hashlib.sha1(payload).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    names=["path", "number", "page_id", "length", "digest"],
                )


def revisits(index: DataFrame) -> DataFrame:
    """(path, number, refers_to, target) of the records that revisit another."""
    long = index.where(F.col("length") >= REVISIT_BYTES)
    rank = F.struct(F.col("page_id"), F.struct((-F.col("number")).alias("n"), F.col("path")).alias("at"))
    best = long.groupBy("digest").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = long.join(best, "digest").where((F.col("path") != F.col("best.at.path")) | (F.col("number") != -F.col("best.at.n")))
    return met.select("path", "number", F.col("best.page_id").alias("refers_to"), F.concat_ws("#", "best.at.path", (-F.col("best.at.n")).cast("string")).alias("target"))


def record_id(path: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{path}#{number}')}>"


def _warc(path: str, number: int, fields: dict, content: bytes, revisit: dict | None) -> bytes:
    head, payload, page_id = _reply(content)
    block = head if revisit else content
    stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.strptime(fields["date"][:14].ljust(14, "0"), "%Y%m%d%H%M%S"))
    digest = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(path, number)}",
        f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {fields['url']}",
        f"WARC-IP-Address: {fields['ip']}",
        f"WARC-Payload-Digest: {digest(payload)}",
        f"WARC-Block-Digest: {digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        target, _, at = revisit["target"].rpartition("#")
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(target, int(at))}"]
        if revisit["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page: {revisit['refers_to']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _convert(folder: str):
    info = b"software: archive converter\r\nformat: WARC File Format 1.1\r\n"

    def first(uri: str) -> bytes:
        return (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(uri, -1)}\r\nWARC-Date: 2000-01-01T00:00:00Z\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        ).encode() + info + b"\r\n\r\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, met in zip(batch.column("path").to_pylist(), batch.column("met").to_pylist(), strict=True):
                out = _Writer(folder, "warc", first)
                by = {m["number"]: m for m in met or []}
                for number, fields, content in arc_records(path):
                    raw = _warc(path, number, fields, content, by.get(number))
                    out.place(len(raw))
                    out.write(raw)
                out.close()
                yield pa.RecordBatch.from_arrays([pa.array(out.closed, pa.string())], names=["path"])

    return run


def _dealt(files: DataFrame, n: int) -> DataFrame:
    """Rows of files dealt over twice as many partitions as there are files: a given number is not merged, however small the rows."""
    return files.repartition(max(1, 2 * n), "path")


def convert(arcs: DataFrame, folder: str) -> DataFrame:
    """Convert ARC files (path) to WARC files in ``folder``; returns the files written (path)."""
    index = stage(_dealt(arcs, arcs.count()).mapInArrow(_index, "path string, number int, page_id long, length long, digest string"), "records")
    # As many rows per file as it has records.
    met = revisits(index).groupBy("path").agg(F.collect_list(F.struct("number", "refers_to", "target")).alias("met"))
    return _dealt(arcs.join(met, "path", "left").select("path", "met"), arcs.count()).mapInArrow(_convert(folder), "path string")


def warc_records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record."""
    reader = _Reader(uri)
    while (line := reader.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{uri}: no record begins here")
        fields = {}
        while line := reader.line():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        yield fields, reader.exactly(int(fields["content-length"]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = lambda x: None if x is None else int(x)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for fields, block in warc_records(path):
                kind = fields["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                n = int(fields["x-payload-length"])
                if kind == "response":
                    _, payload, _ = _reply(block)
                    if len(payload) != n or hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload does not have its digest")
                rows.append((whole(fields.get("x-page-id")), n, digest, kind, whole(fields.get("x-refers-to-page")), fields["warc-record-id"], fields["warc-target-uri"]))
            if rows:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "target_uri"],
                )


def read_warc(files: DataFrame) -> DataFrame:
    """The records of WARC files (path), digests checked."""
    return files.mapInArrow(
        _read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string",
    )


def round_trip(spark: SparkSession, pages: DataFrame, version: str = "both") -> DataFrame:
    """Pages to ARC files, converted to WARC files, read back."""
    folder = work_path(spark, "archives")
    arcs = stage(write_arc(pages, f"{folder}/arc", version), "arc-files")
    warcs = stage(convert(arcs, f"{folder}/warc"), "warc-files")
    return read_warc(_dealt(warcs, warcs.count()))


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
