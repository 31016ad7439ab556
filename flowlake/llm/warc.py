"""WARC archives: one gzip member per record, written by tasks and read sequentially.

Every task writes files of its own into the shared folder and reports them; the list of reported files is
the archive, so what a lost or repeated task left behind is never read. The reader decompresses one member
at a time as its bytes arrive, cuts the record by its content length and checks both digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.scratch import Scratch

#: A task starts a new file after so many compressed bytes.
FILE_BYTES = 64 << 20
_READ = 1 << 16
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member. Line breaks in values would end a header, so they become spaces."""
    clean = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in headers)
    text = f"WARC/1.1\r\n{clean}Content-Length: {len(block)}\r\n\r\n".encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([packer.compress(text), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()])


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that refers to the record with the same payload."""
    revisit = refers_to is not None
    http = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", "sha1:" + digest(block)),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    return _record(headers, block)


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes

    @property
    def type(self) -> str:
        return self.headers["WARC-Type"]

    def payload(self) -> tuple[int, bytes]:
        """Length of the payload as the server sent it, and the payload itself (empty in a revisit)."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        sizes = [line for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        return int(sizes[0].partition(b":")[2]) if sizes else len(body), body


def _members(stream) -> Iterator[bytes]:
    """The content of each gzip member of a binary stream."""
    unzip, parts, data = None, [], b""
    while True:
        data = data or stream.read(_READ)
        if not data:
            break
        unzip = unzip or zlib.decompressobj(31)
        parts.append(unzip.decompress(data))
        data = unzip.unused_data
        if unzip.eof:
            yield b"".join(parts)
            unzip, parts = None, []
    if unzip is not None:
        raise ValueError("the archive ends inside a record")


def read_records(stream) -> Iterator[Record]:
    """The records of one archive file, each checked for framing and digests."""
    for member in _members(stream):
        head, _, rest = bytes(member).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        size = int(headers.get("Content-Length", -1))
        if not version.startswith("WARC/") or size < 0 or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"bad record framing in {headers.get('WARC-Record-ID')}")
        record = Record(headers, rest[:size])
        checks = [("WARC-Block-Digest", record.block)]
        if record.type == "response":
            checks.append(("WARC-Payload-Digest", record.payload()[1]))
        for name, data in checks:
            if name in headers and headers[name] != "sha1:" + digest(data):
                raise ValueError(f"{name} does not match in {headers.get('WARC-Record-ID')}")
        yield record


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def _written(folder: str):
    """page_id, url, payload, refers_to -> the files written."""

    def run(batches):
        store, root = _place(folder)
        store.create_dir(root, recursive=True)
        out, name, records = None, "", 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c for c in batch.columns), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, records = store.open_output_stream(f"{root}/{name}", compression=None), 0
                out.write(page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
                records += 1
                if out.tell() >= FILE_BYTES:
                    out.close()
                    out = None
                    yield pa.record_batch([[f"{folder}/{name}"], [records]], ["path", "records"])
        if out is not None:
            out.close()
            yield pa.record_batch([[f"{folder}/{name}"], [records]], ["path", "records"])

    return run


def _as_long(text: str | None) -> int | None:
    return None if text is None else int(text)


_FIELDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def _read(with_payload: bool):
    def run(batches):
        names = [f.split()[0] for f in _FIELDS.split(", ")] + ["payload"] * with_payload
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = _place(path)
                rows, size = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for r in read_records(stream):
                        length, body = r.payload()
                        row = (
                            _as_long(r.headers.get("X-Page-ID")), r.headers.get("WARC-Target-URI"), r.type,
                            _as_long(r.headers.get("X-Refers-To-Page-ID")),
                            r.headers.get("WARC-Payload-Digest", "").removeprefix("sha1:"), length,
                        )
                        rows.append((*row, body if r.type == "response" else None) if with_payload else row)
                        size += len(body)
                        if size > 1 << 22 or len(rows) >= 4096:
                            yield _batch(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
    return pa.record_batch(columns, names)


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages(page_id, url, html)`` below ``folder``; the files as ``path, records``.

    Of the rows with equal payloads (the html in UTF-8; null is empty) of at least ``least_bytes``, those with
    the smallest ``page_id`` are responses and the others revisits that refer to it. Rows without a
    ``page_id`` are revisits when a row with one has the payload, else responses. ``folder`` must be one that
    all executors reach. An empty table writes nothing. Other columns are not looked at.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    same = [F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")]
    first = rows.select("page_id", *same).groupBy("sha", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = scratch.store(first.where((F.col("n") > 1) & (F.col("size") >= least_bytes)).select("sha", "size", "first"), "repeated")
    rows = rows.select("*", *same).join(first, ["sha", "size"], "left")
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", refers_to.alias("refers_to"))
    return scratch.store(rows.mapInArrow(_written(folder), "path string, records long"), "files")


def read_warc(files: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archive files in ``files(path)``, one file at a time in each task.

    ``page_id, url, record_type, refers_to, payload_digest, payload_bytes`` and, if asked for, ``payload``
    (null in revisits). A record that breaks its framing or a digest ends the read with an error.
    """
    n = max(1, min(files.count(), 100_000))
    paths = files.select("path").repartition(n)
    return paths.mapInArrow(_read(payloads), _FIELDS + ", payload binary" * payloads)
