"""WARC archives: a writer and a splittable reader (operator 1).

Every record is a gzip member of its own.  The reader cuts files into byte ranges; a task scans
its range for gzip's magic bytes, decodes the beginning of each candidate member, accepts it
when a WARC header comes out, and owns the records that start inside the range, reading past
its end for the last one.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped, settle
from docketflow.llm.shared_files import new_folder, opened, written

# Fixed values of the public WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

RANGE_BYTES, FILE_BYTES, READ_BYTES = 16 << 20, 1 << 30, 1 << 18
#: A header is looked for in so many decoded bytes; its first line names a version.
HEADER_BYTES = 1 << 16
FIRST_LINE = re.compile(rb"WARC/1\.[0-9]+\r\n")
PAGE_SPACE = 0x5D0C4E7F10B842A39C6B0F21  # upper bits of the record ids of pages
DATE = "2000-01-01T00:00:00Z"


def page_urn(page_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=(PAGE_SPACE << 64 | page_id & (1 << 64) - 1) & (1 << 128) - 1)}>"


_SPACE = PAGE_SPACE & (1 << 64) - 1


def urn_page(urn: str | None) -> int | None:
    """The page of a record id made by ``page_urn``, else None."""
    if not urn or not urn.startswith("<urn:uuid:"):
        return None
    n = uuid.UUID(urn[10:-1]).int
    if n >> 64 != _SPACE:
        return None
    low = n & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def _header_safe(value: str) -> str:
    return "".join(c if c.isprintable() and c not in "<>" else "".join(
        f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value)


def record(kind: str, urn: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member."""
    head = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: {urn}",
            f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in fields),
            f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = "\r\n".join(head).encode() + b"\r\n\r\n"
    return packer.compress(data) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str,
                refers_to: int | None, refers_null: bool) -> bytes:
    urn = page_urn(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    digest = base64.b32encode(bytes.fromhex(digest_hex)).decode()
    fields = [("WARC-Target-URI", _header_safe(url))] if url else []
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    fields.append(("Content-Type", "application/http;msgtype=response"))
    if refers_null:
        return record("response", urn, fields, http + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", page_urn(refers_to))]
    return record("revisit", urn, fields, http)  # the header block keeps the payload's length


def _archive_writer(folder: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0

        def members() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield page_record(*row, row[4] is None)

        todo = members()
        member = next(todo, None)
        while member is not None:
            uri, size, count = f"{folder}/pages-{part:06d}-{nth:04d}.warc.gz", 0, 0
            with written(uri) as out:
                info = record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>",
                              [("Content-Type", "application/warc-fields")],
                              b"format: WARC File Format 1.1\r\n")
                while member is not None and size < FILE_BYTES:
                    if not size:
                        member = info + member
                    out.write(member)
                    size, count = size + len(member), count + 1
                    member = next(todo, None)
            yield pa.RecordBatch.from_pylist(
                [{"path": uri, "size": size, "records": count}],
                pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())]))
            nth += 1

    return run


def write_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); the manifest is returned.

    The payload is html in UTF-8, empty for null.  Of rows with equal payloads of at least
    ``min_bytes`` bytes, those with the smallest page_id are responses and all others revisit it.
    Rows without a page_id revisit too, or are responses where none of the equal rows has one.
    Repeated rows with the smallest page_id are all responses.  Other columns are ignored.
    Manifest: path, size, records.  No page, no file.
    """
    folder = new_folder(pages.sparkSession, "archives")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Only payloads that several rows share: digests and counts, reduced before the shuffle.
    shared = settle(
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"))
        .where("copies > 1 and first_page is not null").select("digest", "first_page"))
    rows = rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first_page")),
               F.col("first_page")).alias("refers_to"))
    return settle(mapped(rows, _archive_writer(folder), "path string, size bigint, records bigint"))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, size) of the archives at a path or pattern, by Spark's own listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size"))


class _Member:
    """Decodes the gzip member at a position, reading on as needed."""

    def __init__(self, source, at: int):
        self.source, self.at, self.read_to = source, at, at
        self.unpacker = zlib.decompressobj(31)
        self.data = bytearray()

    def more(self, size: int = READ_BYTES, most: int = 0) -> bool:
        if self.unpacker.eof:
            return False
        raw = self.unpacker.unconsumed_tail
        if not raw:
            self.source.seek(self.read_to)
            raw = self.source.read(size)
            self.read_to += len(raw)
        if not raw:
            return False
        self.data += self.unpacker.decompress(raw, most)
        return True

    def header(self) -> dict[str, str] | None:
        """The fields of a whole WARC header, or None if the member does not begin with one."""
        try:
            while b"\r\n\r\n" not in self.data and len(self.data) < HEADER_BYTES and self.more(1 << 12, 1 << 10):
                pass
        except zlib.error:
            return None
        head, end, _ = bytes(self.data).partition(b"\r\n\r\n")
        if not end or not FIRST_LINE.match(bytes(self.data)):
            return None
        fields = header_fields(head)
        named = fields.get("warc-type") and fields.get("warc-record-id")
        return fields if named and fields.get("content-length", "").isdigit() else None

    def whole(self) -> int:
        """Decode to the end; returns where the next member can start."""
        while self.more():
            pass
        if not self.unpacker.eof:
            raise EOFError("the archive ends inside a record")
        return self.read_to - len(self.unpacker.unused_data)


def spans(source, size: int, lo: int, hi: int) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(position, record, None) of the records that start in [lo, hi) of a file, and
    (position, None, reason) of what stands where a record should.

    Records follow each other without a gap.  Each end is therefore the start of a record or the
    end of the file; what else is there is reported once, by the range that owns the record before
    it, and reading goes on at the next member with a valid header.
    """
    at, held, begin = lo, b"", lo
    due = 0 if lo == 0 else None  # where the next record must start, if that is known
    while at < hi:
        found = held.find(MAGIC, at - begin)
        if found < 0:  # read on; magic bytes may lie across the end of what is held
            at = max(at, begin + len(held) - len(MAGIC) + 1)
            source.seek(at)
            held, begin = source.read(min(READ_BYTES, max(0, min(size, hi + len(MAGIC) - 1) - at))), at
            if len(held) < len(MAGIC):
                break
            if held.find(MAGIC) < 0 and begin + len(held) >= min(size, hi + len(MAGIC) - 1):
                break
            continue
        at = begin + found
        if at >= hi:
            break
        member = _Member(source, at)
        if member.header() is None:
            at += 1
            continue
        if due is not None and at != due:
            yield due, None, f"{at - due} bytes are no record"
        try:
            after = member.whole()
        except EOFError as exc:
            yield at, None, str(exc)
            return
        except zlib.error as exc:
            yield at, None, f"the record can't be decoded: {exc}"
            due, at = None, at + 1
            continue
        yield at, bytes(member.data), None
        due = at = after
        if not begin <= at <= begin + len(held):
            held, begin = b"", at
    if due is not None and due < size and (due < hi or _Member(source, due).header() is None):
        yield due, None, "bytes after a record are no record"


def members(source, size: int, lo: int, hi: int) -> Iterator[tuple[int, bytes]]:
    """(position, record) of the records alone."""
    return ((at, data) for at, data, reason in spans(source, size, lo, hi) if reason is None)


def header_fields(head: bytes) -> dict[str, str]:
    """Fields by lower-case name."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and the block of a record."""
    end = data.index(b"\r\n\r\n")
    fields = header_fields(data[:end])
    size = int(fields["content-length"])
    block = data[end + 4 : end + 4 + size]
    if len(block) != size:
        raise EOFError("the record is shorter than its length")
    return fields, block


def _http(block: bytes) -> tuple[bytes, int | None]:
    """The payload of an HTTP response block, and the length it declares."""
    head, _, payload = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return payload, int(value)
    return payload, None


_FOUND = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()),
    ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to_id", pa.string()),
    ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
])
_FOUND_SQL = ("path string, offset bigint, record_type string, record_id string, target_uri string, "
              "refers_to_id string, page_id bigint, refers_to bigint, payload_bytes bigint, "
              "payload_digest string, payload binary, error string")


def _row(path: str, at: int, data: bytes | None, reason: str | None, payloads: bool) -> dict:
    """A record, or the reason why there is none at ``at``."""
    try:
        if data is not None:
            return _record(path, at, data, payloads)
    except (EOFError, ValueError) as exc:
        reason = str(exc)
    return {"path": path, "offset": at, "error": reason}


def _record(path: str, at: int, data: bytes, payloads: bool) -> dict:
    fields, block = parsed(data)
    kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "")
    size = None
    payload: bytes | None = block
    if fields.get("content-type", "").startswith("application/http"):
        payload, size = _http(block)
    if kind == "revisit":
        digest, payload = declared.removeprefix("sha1:") or None, None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        size = len(payload)
        if declared.startswith("sha1:") and declared[5:] != digest:
            raise ValueError("the record fails its digest")
    urn, refers = fields.get("warc-record-id"), fields.get("warc-refers-to")
    return {"path": path, "offset": at, "record_type": kind, "record_id": urn,
            "target_uri": fields.get("warc-target-uri"), "refers_to_id": refers,
            "page_id": urn_page(urn), "refers_to": urn_page(refers), "payload_bytes": size,
            "payload_digest": digest, "payload": payload if payloads else None}


def _range_reader(payloads: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows, held = [], 0
                with opened(r["path"]) as source:
                    for at, data, reason in spans(source, r["size"], r["lo"], r["hi"]):
                        rows.append(_row(r["path"], at, data, reason, payloads))
                        held += len(data or b"") if payloads else 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _FOUND)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _FOUND)

    return run


def read_records(files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives ``files`` (path, size), read by byte ranges.

    Columns as in the schema above: page ids where this module wrote the record, digests
    checked against the payload, and for revisits the digest and length that the header and the
    HTTP block declare.  Without ``payloads`` that column is null.  What is damaged or cut gives a row
    with path, offset and ``error`` alone, and the records after it are read.  An archive inside a payload that
    is stored without compression could look like records of its own; this writer makes none.
    """
    files = settle(files.where("size > 0"))
    ranges = files.select(
        "path", "size",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("lo"),
    ).withColumn("hi", F.least(F.col("lo") + range_bytes, "size"))
    count = files.agg(F.sum(F.ceil(F.col("size") / range_bytes))).first()[0] or 1
    return mapped(ranges.repartition(int(count)), _range_reader(payloads), _FOUND_SQL)
