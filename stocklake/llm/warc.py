"""WARC archives: a writer of compressed records and a reader that salvages damaged files.

An archive is a file of gzip members, one per record. The reader checks each member's
checksum, and of each record the version line, lengths and block digest. Where a check
fails it searches for the next place a member or a version line begins and goes on there;
what lies between is reported as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklake.llm.common import Staging, map_arrow

MIN_REVISIT = 1000
RECORDS_PER_FILE = 1000
VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
BLANK_LINE = re.compile(rb"\r\n\r\n")
MEMBER = b"\x1f\x8b\x08"
#: A gzip member that holds nothing, written between records as the line separator of
#: Spark's text files; its bytes as Latin-1 characters.
EMPTY_MEMBER = gzip.compress(b"", mtime=0).decode("latin-1")
#: A member is unpacked in slices of so many bytes, so that what follows it is not copied.
SLICE = 1 << 14
DATE = "2024-01-01T00:00:00Z"


# ---- records -------------------------------------------------------------------------


def _digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uri(text: str) -> str:
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record: a response, or with ``refers_to`` a revisit, whose block has the HTTP
    head of the response without its payload."""
    name = "none" if page_id is None else str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{name}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": _digest32(payload),
        "WARC-Block-Digest": _digest32(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = _uri(url)
    if refers_to is not None:
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{key}: {value}\r\n" for key, value in head.items())
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class Damaged(Exception):
    pass


def _parse(data: bytes, start: int, blank_lines: _Places) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``start``, checked."""
    version = VERSION_LINE.match(data, start)
    if not version:
        raise Damaged("no version line")
    close = blank_lines.after(version.end() - 2)
    if close == len(data):
        raise Damaged("header does not end")
    headers = {}
    for line in data[version.end() : close].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise Damaged("no content length")
    begin = close + 4
    end = begin + int(size)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    block = data[begin:end]
    stated = headers.get("warc-block-digest")
    if stated and stated.startswith("sha1:") and stated != _digest32(block):
        raise Damaged("block digest differs")
    return headers, block, end + 4


def _unpack(data: bytes, start: int) -> tuple[bytes, int]:
    """Contents and end of the gzip member at ``start``, checksum and length checked."""
    stream, out, at = zlib.decompressobj(31), [], start
    try:
        while not stream.eof and at < len(data):
            out.append(stream.decompress(data[at : at + SLICE]))
            at += SLICE
    except zlib.error as error:
        raise Damaged(f"member: {error}") from None
    if not stream.eof:
        raise Damaged("member does not end")
    return b"".join(out), min(at, len(data)) - len(stream.unused_data)


class _Places:
    """The next places of a pattern, for questions that go forward: what was found, or
    found missing, is not searched for again, so a whole archive is searched once."""

    def __init__(self, data: bytes, pattern: re.Pattern):
        self.data, self.pattern, self.place = data, pattern, -1

    def after(self, at: int) -> int:
        """The first place from ``at`` on, the end of the data if there is none."""
        if self.place < at:
            found = self.pattern.search(self.data, at)
            self.place = found.start() if found else len(self.data)
        return self.place


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Records and gaps of an archive in order. Compressed and plain records may be mixed."""
    at = gap = 0
    reason = ""
    starts = [_Places(data, re.compile(re.escape(MEMBER))), _Places(data, VERSION_LINE)]
    blank_lines = _Places(data, BLANK_LINE)
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                inner, end = _unpack(data, at)
                found = list(_inner(inner, at, end - at))
            else:
                headers, block, end = _parse(data, at, blank_lines)
                found = [Record(at, end - at, headers, block)]
        except Damaged as error:
            reason = reason or str(error)
            at = min(places.after(at + 1) for places in starts)
            continue
        if gap < at:
            yield Gap(gap, at - gap, reason)
        reason = ""
        yield from found
        at = gap = end
    if gap < at:
        yield Gap(gap, at - gap, reason)


def _inner(data: bytes, offset: int, length: int) -> Iterator[Record | Gap]:
    """The records of one member; what fails in it is a gap with the member's place."""
    at, reason = 0, ""
    starts, blank_lines = _Places(data, VERSION_LINE), _Places(data, BLANK_LINE)
    while at < len(data):
        try:
            headers, block, at = _parse(data, at, blank_lines)
        except Damaged as error:
            reason = reason or str(error)
            at = starts.after(at + 1)
            continue
        yield Record(offset, length, headers, block)
    if reason:
        yield Gap(offset, length, f"in member: {reason}")


# ---- tables --------------------------------------------------------------------------


def write_archives(pages: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``page_id, url, html, refers_to`` rows as compressed records.

    The rows go out as lines of Spark's text writer, a line being a gzip member, with an
    empty member as the separator; so task retries and commits are Spark's, on any file
    system. A file has at most ``per_file`` records.
    """

    def run(batches):
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True)
            made = [
                gzip.compress(record_bytes(page, url, (html or "").encode("utf-8", "replace"), refers), 6, mtime=0)
                for page, url, html, refers in rows
            ]
            yield pa.record_batch([pa.array(made, pa.binary())], names=["member"])

    members = map_arrow(pages.select("page_id", "url", "html", "refers_to"), run, "member binary")
    (
        members.select(F.col("member").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER)
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


RECORDS = (
    "file string, offset long, length long, quarantined string, record_id string, "
    "record_type string, refers_to string, uri string, payload_bytes long, payload_digest string"
)
_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    + [(c, pa.string()) for c in ("quarantined", "record_id", "record_type", "refers_to", "uri")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def _row(file: str, found: Record | Gap) -> dict:
    row = {"file": file, "offset": found.offset, "length": found.length}
    if isinstance(found, Gap):
        return row | {"quarantined": found.reason}
    head = found.headers
    http, _, payload = found.block.partition(b"\r\n\r\n")
    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    if head.get("warc-type") == "revisit":
        stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        size = int(stated[1]) if stated else None
        text = head.get("warc-payload-digest", "").removeprefix("sha1:")
        digest = base64.b32decode(text).hex() if len(text) == 32 else None
    return row | {
        "record_id": head.get("warc-record-id"),
        "record_type": head.get("warc-type"),
        "refers_to": head.get("warc-refers-to"),
        "uri": head.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
    }


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record, and per quarantined gap, of the archives below ``path``.

    Of gaps only ``file, offset, length, quarantined`` (the reason) are set. An archive is
    read whole by one task, so it must be below 2 GB, the limit of a binary value; the
    writer bounds how large one gets. Time is linear in its bytes, damaged or not. Empty
    files give no rows.
    """

    def run(batches):
        for batch in batches:
            for file, data in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = [_row(file, found) for found in salvage(data.as_py())]
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_arrow(files, run, RECORDS)


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """The pages with ``refers_to``: of equal payloads of ``min_bytes`` and more the
    largest ``page_id``, null on that page itself.

    Payloads are compared by SHA-1 and length, summed up map-side; only payloads that
    occur twice are joined back, and the join may split one that many pages share.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.withColumn("_sha", F.sha1(payload)).withColumn("_bytes", F.length(payload))
    copies = (
        pages.where(F.col("_bytes") >= min_bytes)
        .groupBy("_sha", "_bytes")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    marked = pages.join(copies, ["_sha", "_bytes"], "left")
    other = ~F.col("page_id").eqNullSafe(F.col("_first"))
    return marked.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_sha", "_bytes", "_first")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write a record per page, read the archives back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``.

    A null html is an empty payload, a null url leaves the target out, a null ``page_id``
    comes back null. Repeated rows give a record each; those of the largest ``page_id``
    are all responses. Other columns are not stored; an empty table gives no rows. A gap
    in what was just written is an error.
    """
    staging = Staging(pages.sparkSession, "warc")
    path = staging.path("archives")
    write_archives(mark_revisits(pages.select("page_id", "url", "html")), path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    records = read_archives(pages.sparkSession, path)
    # Nothing is passed over in silence: these archives were written just now.
    lost = F.raise_error(F.concat(F.lit("gap in an archive just written: "), "file", F.lit(" "), "quarantined"))
    whole = F.when(F.col("quarantined").isNull(), True).otherwise(lost.cast("boolean"))
    return records.where(whole).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )
