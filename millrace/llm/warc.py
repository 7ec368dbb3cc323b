"""WARC archives: write pages as records, read archives back, salvage damaged ones.

``write_warc`` lays records out as strings and lets Spark's text writer store
them, uncompressed, on any file system; every record ends in the writer's line
end.  Pages with equal payloads become one ``response`` (the largest page_id)
and ``revisit`` records without payload that refer to it.

``read_warc`` reads whole archives (plain, or gzip with one or many records in
a member) and checks each record: version line, lengths, end mark, payload
digest.  A record whose length and end mark are right and whose digest differs is a
gap of just its bytes.  After other damage the reader searches for the next valid
gzip member or version line, goes on there, and reports the bytes between as a
gap.  A payload may hold what looks like a record, so a record found by a search
counts only if its payload digest agrees, or if it has none to check and leads
straight to one that agrees or to the archive's end; else it is ``unsure``, a kind
of its own, and the search goes on behind it.  Records that a broken gzip member
holds before its break are kept if their payload digest agrees; they have length
0, as the member's bytes are the gap's.

An archive takes linear time: members are inflated a piece at a time, headers
end within ``MAX_HEADER`` bytes, a search never reads a header over the next
version line, and the bytes that it inflates or digests in vain are bounded by
``WASTE`` times the archive; what it would meet beyond that is one gap that says
so.  Gzip members inside members are opened ``MAX_DEPTH`` deep.

Archives hold about ``TARGET_BYTES`` each, so that one fits a task, and never
more than ``MOST_BYTES`` however page sizes are spread.  Defined
cases: a null payload is empty; a null url or page_id is left out of the
header and read back as null; a row with a null page_id refers to a response
with one if its payload is not new, and is a response otherwise; rows repeated
with one page_id are responses both; very long payloads are records of their
own archive at worst; an empty table gives no records; other columns, of any
name, are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import written

TARGET_BYTES = 32 << 20
#: Below the 2 GB that a reader of whole files can take.
MOST_BYTES = 1 << 30
PIECE = 1 << 16
MAX_HEADER = 1 << 16
MAX_DEPTH = 4
WASTE = 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_NEXT = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


@dataclass
class Found:
    """A record, or a gap with the reason why its bytes were set aside."""

    kind: str
    offset: int
    length: int
    headers: dict[str, str]
    payload_bytes: int | None = None
    payload_digest: str | None = None
    payload: bytes | None = None
    reason: str | None = None


class _Broken(Exception):
    """``resume`` is where to go on, if that is known; ``spent`` counts bytes that were read in vain."""

    def __init__(self, reason: str, resume: int | None = None, spent: int = 0):
        super().__init__(reason)
        self.resume, self.spent = resume, spent


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, sep, v in (line.partition(":") for line in lines[1:]) if sep}


def _record(data: bytes, at: int, searching: bool = False) -> tuple[Found, int, bool]:
    """The record that starts at ``at``, the place after it, and whether its digest agrees."""
    stop = len(data)
    if searching and (following := _VERSION.search(data, at + 1, at + MAX_HEADER)):
        # headers of two candidates never overlap
        stop = following.start()
    end = data.find(b"\r\n\r\n", at, min(stop, at + MAX_HEADER))
    if end < 0:
        raise _Broken("header without end")
    headers = _fields(data[at:end])
    if not headers.get("content-length", "").isdecimal():
        raise _Broken("no content length")
    start = end + 4
    stop = start + int(headers["content-length"][:18])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise _Broken("record end not where its length says")
    block = data[start:stop]
    size, digest, payload = len(block), headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, block
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if headers.get("warc-type") == "revisit":
            length = _fields(head).get("content-length", "")
            size = int(length) if length.isdecimal() else None
    agrees = False
    if headers.get("warc-type") != "revisit":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest not in (None, own):
            # found by a search, it may be a payload's text, and its end no record's end
            raise _Broken("payload digest differs", None if searching else stop + 4, len(block))
        agrees = digest is not None
        digest = own
    return Found("record", at, stop + 4 - at, headers, size, digest, payload), stop + 4, agrees


class _BrokenMember(_Broken):
    """A gzip member that ends early or fails; ``whole`` holds what it gave before."""

    def __init__(self, reason: str, whole: bytes):
        super().__init__(reason, None, len(whole))
        self.whole = whole


def _inflated(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and the place after it."""
    inflate, out, pos, size = zlib.decompressobj(31), [], at, 0
    while pos < len(data):
        piece, before = data[pos : pos + PIECE], inflate.copy()
        try:
            out.append(inflate.decompress(piece))
        except zlib.error as e:
            # byte by byte up to the error
            try:
                for i in range(len(piece)):
                    out.append(before.decompress(piece[i : i + 1]))
            except zlib.error:
                pass
            raise _BrokenMember(f"gzip member: {e}", b"".join(out)) from e
        pos += len(piece)
        size += len(out[-1])
        if inflate.eof:
            return b"".join(out), pos - len(inflate.unused_data)
        if size > MOST_BYTES:
            raise _BrokenMember("gzip member too large", b"".join(out))
    raise _BrokenMember("gzip member without end", b"".join(out))


def salvage(data: bytes, depth: int = 0) -> Iterator[Found]:
    """All records that can be read, what may be records, and the gaps between them, in order."""
    at, gap, reason, view, waste = 0, None, "", memoryview(data), WASTE * len(data) + (1 << 20)
    searching, pending = False, []

    def closed(end: int) -> Iterator[Found]:
        if gap is not None:
            yield Found("gap", gap, end - gap, {}, reason=reason)

    def settled(sure: bool) -> Iterator[Found]:
        """Records without a digest of their own that a search has met, one behind the other."""
        for found in pending:
            if not sure:
                found.kind, found.reason = "unsure", "no digest, behind damage"
            yield found
        pending.clear()

    while at < len(data):
        try:
            if data[at : at + 3] == b"\x1f\x8b\x08":
                if depth >= MAX_DEPTH:
                    raise _Broken(f"more than {MAX_DEPTH} gzip members inside each other")
                inner, stop = _inflated(view, at)
                yield from settled(True)
                yield from closed(at)
                gap, searching = None, False
                for found in salvage(inner, depth + 1):  # places inside a member are reported as the member's
                    found.offset, found.length = at, stop - at
                    yield found
            elif _VERSION.match(data, at):
                found, stop, agrees = _record(data, at, searching)
                if searching and not agrees:
                    yield from closed(at)
                    gap = None
                    pending.append(found)
                else:
                    yield from settled(True)
                    yield from closed(at)
                    gap, searching = None, False
                    yield found
            else:
                raise _Broken("no version line or gzip member")
            at = stop
        except _Broken as e:
            yield from settled(False)
            if isinstance(e, _BrokenMember):
                for found in salvage(e.whole, depth + 1) if depth < MAX_DEPTH else ():
                    if found.kind == "record" and "warc-payload-digest" in found.headers:
                        found.offset, found.length = at, 0
                        yield found
            if gap is None:
                gap, reason = at, str(e)
            if e.resume is not None:
                yield from closed(e.resume)
                gap, at = None, e.resume
                continue
            searching = True
            waste -= e.spent
            if waste < 0:
                reason = "too much that only looks like records"
                break
            following = _NEXT.search(data, at + 1)
            at = following.start() if following else len(data)
    yield from settled(True)
    yield from closed(len(data))


def base32_sha1(payload: Column) -> Column:
    """Base32 of the SHA-1, from 20 bits (5 hex digits, 4 base-32 digits) at a time."""
    digits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def record_column(refers_to: str = "refers_to") -> Column:
    """The record of a row (page_id, url, payload, digest, refers_to), short of its last line end."""
    revisit = F.col(refers_to).isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), field("WARC-Record-ID", _urn(F.col("page_id"))),
        field("WARC-Date", F.lit(DATE)), field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", "%0A")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Profile", F.when(revisit, PROFILE)), field("WARC-Refers-To", F.when(revisit, _urn(F.col(refers_to)))), field("Content-Type", F.lit("application/http;msgtype=response")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r"),
    )


def write_warc(pages: DataFrame, path: str, payload: str = "html", url: str = "url", page_id: str = "page_id", min_revisit_bytes: int = 0, target_bytes: int = TARGET_BYTES) -> None:
    """One record for each row.  Equal payloads of at least ``min_revisit_bytes`` share one response.

    Payloads are not shuffled unless the table of repeated digests is too large
    for Spark to send to all tasks; then the join on digests splits hot ones.
    """
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    own = own.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    repeated = own.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("response")).filter("n > 1").select("digest", "response")
    mean, most = own.agg(F.coalesce(F.avg(F.octet_length("payload")), F.lit(0.0)), F.coalesce(F.max(F.octet_length("payload") + F.coalesce(F.octet_length("url"), F.lit(0))), F.lit(0))).first()
    # written first, so that its true size decides how it is joined
    joined = own.join(written(repeated, "warc-repeated"), "digest", "left")
    refers = F.when((F.octet_length("payload") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    records = joined.withColumn("refers_to", refers).select(record_column().alias("value"))
    # as many as usually give the target, but never more than the longest payload allows
    per_file = max(1, min(int(target_bytes / (mean + 400)), MOST_BYTES // (most + 1000)))
    records.write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)


_NUMBER = re.compile(r"<urn:page:(-?\d+)>")


def _page(value: str | None) -> int | None:
    m = _NUMBER.fullmatch(value or "")
    return int(m[1]) if m else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record and each gap of all archives under ``path``."""
    names = ["archive", "kind", "start", "length", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "reason"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for f in salvage(content.as_py()):
                    h = f.headers.get
                    rows.append((archive.as_py(), f.kind, f.offset, f.length, _page(h("warc-record-id")), h("warc-target-uri"), f.payload_bytes, f.payload_digest, h("warc-type"), _page(h("warc-refers-to")), f.reason))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "archive string, kind string, start long, length long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, reason string"
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, schema)


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of all archives under ``path``, read once and written to the shared folder."""
    found = written(read_warc(spark, path), "warc-found")
    return found.filter("kind = 'record'"), found.filter("kind = 'gap'").select("archive", "start", "length", "reason")


RECORDS_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS response FROM p)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM m
"""
