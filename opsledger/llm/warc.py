"""WARC archives of pages: write, and read with salvage.

Each record is a gzip member of its own. Of pages with equal payloads of at least
``REVISIT_BYTES`` the one with the largest id is a response, the others are revisits
without a payload. Archives roll over at ``ROLL_BYTES``. A writing task names its files
at random and reports them; only files reported by finished tasks count, so
tasks that are repeated on other executors do no harm.

The reader checks each record: whole gzip member with its checksum, version line,
headers, length, and both digests. Where a check fails, it searches for the next
place that starts a valid gzip member or version line, reads on from there, and
reports the bytes between as a gap. It reads files in blocks and holds one record.

Null html is an empty payload; a null url has no target header, a null id no page
in the record id and reads back as null. Rows with null ids never are the response
of a group with other ids. Repeated rows are all written. An empty table writes
no file and reads as no records. Other columns of the pages are ignored.
"""

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsledger.functions.joins import lookup_join
from opsledger.functions.workspace import new_folder, stored

REVISIT_BYTES = 1000
ROLL_BYTES = 32 * 1024 * 1024
_BLOCK = 1 << 20
_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_PAGE = "urn:page:"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")

ARCHIVE = "path string, records long, bytes long"
_FIELDS = (
    ("kind", pa.string()),
    ("path", pa.string()),
    ("start", pa.int64()),
    ("end", pa.int64()),
    ("reason", pa.string()),
    ("record_type", pa.string()),
    ("url", pa.string()),
    ("page_id", pa.int64()),
    ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("payload", pa.binary()),
)
_ARROW = pa.schema(_FIELDS)
_DDL = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
RECORD = ", ".join(f"`{name}` {_DDL[kind]}" for name, kind in _FIELDS)


def mark_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Add ``refers_to``: the page whose payload a page repeats, else null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(
        "page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("__digest"),
        F.octet_length(html).alias("__bytes"),
    )
    shared = (
        keyed.filter(F.col("__bytes") >= least_bytes)
        .groupBy("__digest")
        .agg(F.max("page_id").alias("__keeper"), F.count("*").alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )
    joined = lookup_join(keyed, shared, ["__digest"], "left")
    other = ~F.col("page_id").eqNullSafe(F.col("__keeper"))
    return joined.select(
        "page_id", "url", "html", F.when(other, F.col("__keeper")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages to archives under ``folder``; a row for each archive."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    roll = ROLL_BYTES

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, records, size = None, None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                member = _gzip(_record(**row))
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= roll:
                    out.close()
                    out = None
                    yield _archive(folder, name, records, size)
        if out is not None:
            out.close()
            yield _archive(folder, name, records, size)

    return stored(mark_revisits(pages).mapInArrow(run, ARCHIVE), "warc-list")


def _archive(folder, name, records, size):
    return pa.RecordBatch.from_pydict(
        {"path": [f"{folder}/{name}"], "records": [records], "bytes": [size]}
    )


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _record(page_id, url, html, refers_to) -> bytes:
    payload = html.encode()
    digest = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{_PAGE}{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
        ("WARC-Payload-Digest", _base32(digest)),
        ("X-Payload-Length", len(payload)),
    ]
    if url is not None:
        headers.append(
            ("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
        )
    if refers_to is not None:
        headers += [
            ("WARC-Refers-To", f"<{_PAGE}{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives in column ``path``, in ``RECORD`` form."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for row in read_archive(path, payloads):
                    rows.append(row)
                    if len(rows) >= 256:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = max(1, archives.count())
    return archives.select("path").repartition(files, "path").mapInArrow(run, RECORD)


class _File:
    """Random access to a file in any store that Arrow opens, by block."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(name)
        self.size = self.file.size()

    def read(self, start: int, count: int) -> bytes:
        return self.file.read_at(max(0, min(count, self.size - start)), start)

    def find(self, pattern: re.Pattern, start: int, overlap: int = 64) -> int | None:
        while start < self.size:
            found = pattern.search(self.read(start, _BLOCK + overlap))
            if found and found.start() < _BLOCK:
                return start + found.start()
            start += _BLOCK
        return None


def read_archive(path: str, payloads: bool = True):
    """Each valid record and each gap of one file, gzipped by member or plain."""
    file = _File(path)
    start, gap, reason = 0, None, None
    marks = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")
    while start < file.size:
        row, end, why = _read_at(file, start)
        if row is None:
            if gap is None:
                gap, reason = start, why
            found = file.find(marks, start + 1)
            start = file.size if found is None else found
            continue
        if gap is not None:
            yield _gap(path, gap, start, reason)
            gap = None
        row |= {"kind": "record", "path": path, "start": start, "end": end}
        if not payloads:
            row["payload"] = None
        yield row
        start = end
    if gap is not None:
        yield _gap(path, gap, file.size, reason)


def _gap(path, start, end, reason):
    return {"kind": "gap", "path": path, "start": start, "end": end, "reason": reason}


def _read_at(file: _File, start: int):
    """The record that starts here and its end, or the reason why there is none."""
    head = file.read(start, 16)
    if head[:3] == _MAGIC:
        packed = zlib.decompressobj(31)
        data, at = bytearray(), start
        while not packed.eof:
            block = file.read(at, _BLOCK if at > start else 1 << 14)
            if not block:
                return None, None, "the gzip member is cut short"
            try:
                data += packed.decompress(block)
            except zlib.error:
                return None, None, "the gzip member is damaged"
            if len(data) >= 5 and not data.startswith(b"WARC/"):
                return None, None, "the gzip member holds no record"
            at += len(block)
        end = at - len(packed.unused_data)
        row, used, why = _parse(lambda a, n: bytes(data[a : a + n]), 0, len(data))
        if row is not None and used != len(data):
            return None, None, "the gzip member holds more than a record"
        return row, end, why
    if _VERSION.match(head):
        return _parse(file.read, start, file.size)
    return None, None, "no record starts here"


def _parse(read, start: int, size: int):
    """Parse and check the record at ``start``; ``read`` takes place and length."""
    head, step = b"", 1 << 12
    while b"\r\n\r\n" not in head:
        if start + len(head) >= size:
            return None, None, "the headers have no end"
        head += read(start + len(head), step)
        step *= 2
    head = head[: head.index(b"\r\n\r\n")]
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not _VERSION.match(head + b"\r\n"):
        return None, None, "no version line"
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return None, None, "a header line has no name"
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,18}", length):
        return None, None, "no length"
    at, length = start + len(head) + 4, int(length)
    if at + length + 4 > size:
        return None, None, "the block is cut short"
    block = read(at, length + 4)
    if block[length:] != b"\r\n\r\n":
        return None, None, "the block has another length"
    block = block[:length]
    if not _matches(headers.get("warc-block-digest"), block):
        return None, None, "the block has another digest"
    kind = headers.get("warc-type", "")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    said = headers.get("warc-payload-digest")
    if kind == "revisit":
        digest = _hex(said)
        count = headers.get("x-payload-length", "")
        count = int(count) if re.fullmatch(r"[0-9]{1,18}", count) else None
        payload = None
    else:
        if not _matches(said, payload):
            return None, None, "the payload has another digest"
        digest, count = hashlib.sha1(payload).hexdigest(), len(payload)
    row = {
        "record_type": kind,
        "url": headers.get("warc-target-uri"),
        "page_id": _page(headers.get("warc-record-id")),
        "refers_to": _page(headers.get("warc-refers-to")),
        "payload_bytes": count,
        "payload_digest": digest,
        "payload": payload,
    }
    return row, at + length + 4, None


def _matches(said: str | None, data: bytes) -> bool:
    return not said or not said.startswith("sha1:") or _hex(said) == hashlib.sha1(data).hexdigest()


def _hex(said: str | None) -> str | None:
    try:
        return base64.b32decode(said.removeprefix("sha1:")).hex() if said else None
    except ValueError:
        return "not base 32"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(rf"<{_PAGE}(-?[0-9]{{1,19}})>", name or "")
    return int(found[1]) if found else None
