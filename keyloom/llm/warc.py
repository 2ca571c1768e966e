"""Web archives: a record per page, revisits for repeated payloads, and a reader that salvages damaged files.

Archives are written as text files of raw bytes, so that any file system Spark writes to will do and the
commit of the job covers them. They are read as text, too, cut at a marker (the version line, or the first
bytes of a gzip member), which brings a file's bytes in order and in bounded parts to the task that reads
the file, however large it is. Where a record fails its checks (version line, header, length, trailer,
digests; the checksum of a gzip member), the reader searches for the next marker and tries again there;
bytes between good records are logged with their place.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyloom.llm.common import few
from keyloom.session import ensure_checkpoint_dir

PLAIN, MEMBER = b"WARC/1.", b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
END = b"\r\n\r\n"
LONGEST_HEADER = 1 << 16
#: A gzip member of nothing: it ends every member's row, as the text writer puts something after each.
EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, is_revisit: bool, date: str) -> bytes:
    """Bytes of a record up to the line end that the writer adds. Control characters and blanks of the url are percent-encoded."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if is_revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(first, digest)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block + b"\r\n"


def responses(pages: DataFrame, least: int, hot: int = 1000, small: int = 250_000) -> DataFrame:
    """pages and ``_first``: the smallest page_id of the rows with this payload; null where no other row has it or it is shorter than ``least`` bytes.

    Digests that a ``hot``-th of all rows or more share, of which there are ``hot`` at most, are looked up by
    broadcast, so that none of them meets in one task; the others by broadcast up to ``small``, beyond that by a shuffle.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    digest = F.when(F.length(payload) >= least, F.unhex(F.sha1(payload)))
    groups = pages.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_n"), F.min("page_id").alias("_first"))
    groups = groups.filter("_digest is not null and _n > 1")
    limit = pages.count() / hot
    many, rest = groups.filter(F.col("_n") >= limit).drop("_n"), groups.filter(F.col("_n") < limit).drop("_n")
    known = pages.withColumn("_digest", digest).join(F.broadcast(many), "_digest", "left").withColumnRenamed("_first", "_hot")
    # rows that are answered, or have no payload to look up, stay where they are: a null key matches nothing and is no hot key
    apart = F.encode(F.concat(F.lit("-"), F.xxhash64("page_id", "url", F.spark_partition_id()).cast("string")), "utf-8")
    key = F.when(F.col("_hot").isNull() & F.col("_digest").isNotNull(), F.col("_digest")).otherwise(apart)
    known = known.withColumn("_key", key).join(few(rest.withColumnRenamed("_digest", "_key"), small), "_key", "left")
    return known.withColumn("_first", F.coalesce("_hot", "_first")).drop("_hot", "_key", "_digest")


def write_archives(pages: DataFrame, path: str, least: int = 0, compress: bool = False, date: str = "2020-01-01T00:00:00Z") -> None:
    """A record for every row of pages (page_id, url, html), in as many files below ``path`` as pages has partitions.

    The payload is the html in UTF-8, a null one is empty. Of the rows with one payload of ``least`` bytes or
    more, that with the smallest page_id is a response and the others are revisits of it, without their payload;
    rows that repeat the smallest page_id are responses, too. Rows without a page_id are revisits of one that has
    one, and responses if there is none. Shorter payloads are always responses. ``compress`` makes each record a
    gzip member. An empty table makes an archive without records; other columns do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for page_id, url, html, first, revisit in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                data = record(page_id, url, html, first, revisit, date)
                if compress:
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = z.compress(data + b"\r\n") + z.flush()
                out.append(data)
                size += len(data)
                if size > 1 << 24:
                    yield pa.record_batch([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.record_batch([pa.array(out, pa.binary())], ["value"])

    decided = responses(pages.select(F.col("page_id").cast("long"), "url", "html"), least)
    revisit = F.coalesce((F.col("_first") != F.col("page_id")) | (F.col("_first").isNotNull() & F.col("page_id").isNull()), F.lit(False))
    rows = decided.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"), "_first", revisit.alias("_revisit"))
    lines = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    ends = {"lineSep": EMPTY_MEMBER.decode("latin-1"), "encoding": "ISO-8859-1"} if compress else {"lineSep": "\r\n"}
    lines.write.options(**ends).text(path)


@dataclass
class Failed(Exception):
    reason: str


class NeedsMore(Exception):
    """A record goes beyond the bytes that are there: it has ``size`` bytes, or it is worth another try with as many (``guess``)."""

    def __init__(self, size: int, guess: bool = False):
        self.size, self.guess = size, guess


@dataclass
class Record:
    length: int  # bytes in the file
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    payload_bytes: int | None = None
    digest: str | None = None


def parse(data: bytes | bytearray, last: bool) -> Record:
    """The record at the start of data; ``last``: no more bytes follow."""
    if not VERSION.match(data):
        if len(data) < 10 and not last:
            raise NeedsMore(10, True)
        raise Failed("no version line")
    at = data.find(END, 0, LONGEST_HEADER)
    if at < 0:
        if len(data) < LONGEST_HEADER and not last:
            raise NeedsMore(min(LONGEST_HEADER, 2 * len(data)), True)
        raise Failed("no end of the header")
    headers, name = {}, None
    for line in bytes(data[10:at]).decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            headers[name] += " " + line.strip()
        else:
            name, colon, value = line.partition(":")
            name = name.strip().lower()
            if not colon or name in headers:
                raise Failed("a bad header line")
            headers[name] = value.strip()
    if not re.fullmatch(r"[0-9]{1,18}", headers.get("content-length", "")):
        raise Failed("no length")
    lo = at + len(END)
    hi = lo + int(headers["content-length"])
    if len(data) < hi + len(END):
        if last:
            raise Failed("cut short")
        raise NeedsMore(hi + len(END))
    if data[hi : hi + len(END)] != END:
        raise Failed("no end where the length says")
    block = bytes(data[lo:hi])
    checked(headers, "warc-block-digest", block)
    return content(Record(hi + len(END), headers), block)


def checked(headers: dict[str, str], name: str, data: bytes) -> str | None:
    """The SHA-1 that a header gives, which must be that of the data; None if it gives none."""
    kind, _, digest = headers.get(name, "").partition(":")
    if kind.lower() != "sha1":
        return None
    if digest.upper() != base32_sha1(data):
        raise Failed(f"{name} differs")
    return digest.upper()


def content(r: Record, block: bytes) -> Record:
    """Payload, its size and digest; a revisit has what its headers say of the payload that it stands for."""
    is_http = r.headers.get("content-type", "").startswith("application/http")
    head, end, body = block.partition(END) if is_http else (b"", b"", block)
    if is_http and not end:
        raise Failed("no end of the HTTP header")
    if r.headers.get("warc-type") == "revisit":
        told = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", head)
        r.payload_bytes = int(told[1]) if told else None
        r.digest = r.headers.get("warc-payload-digest", "").partition(":")[2].upper() or None
    else:
        r.payload, r.payload_bytes = body, len(body)
        r.digest = checked(r.headers, "warc-payload-digest", body) or base32_sha1(body)
    return r


def parse_member(data: bytes | bytearray, last: bool) -> Record | None:
    """The record in the gzip member at the start of data; None and only a length (in ``headers``) for an empty member."""
    z, parts, at = zlib.decompressobj(31), [], 0
    with memoryview(data) as view:
        while at < len(view) and not z.eof:
            try:
                parts.append(z.decompress(view[at : at + LONGEST_HEADER]))
            except zlib.error as e:
                raise Failed("a bad member") from e
            at = min(at + LONGEST_HEADER, len(view))
    if not z.eof:
        if last:
            raise Failed("cut short")
        raise NeedsMore(2 * len(data), True)
    length, inside = at - len(z.unused_data), b"".join(parts)
    if not inside:
        return Record(length)
    r = parse(inside, True)
    if r.length != len(inside):
        raise Failed("more than a record in a member")
    r.length = length
    return r


class Salvage:
    """Reads a file of ``total`` bytes as they come; no more is held than a record says it has, and the file has.

    ``found`` gets (offset, record) and (offset, length, reason) of gaps."""

    def __init__(self, marker: bytes, total: int):
        self.marker, self.total, self.parse = marker, total, parse if marker == PLAIN else parse_member
        self.data, self.at, self.needed = bytearray(), 0, 0
        self.gap: tuple[int, str] | None = None
        self.found: list[tuple] = []

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.at += n

    def lost(self, reason: str) -> None:
        self.gap = self.gap or (self.at, reason)

    def closed(self) -> None:
        if self.gap:
            self.found.append((self.gap[0], self.at - self.gap[0], self.gap[1]))
            self.gap = None

    def feed(self, more: bytes, last: bool = False) -> None:
        self.data += more
        if len(self.data) < self.needed and not last:
            return
        self.needed = 0
        while self.data:
            if not self.data.startswith(self.marker):
                if not last and self.marker.startswith(self.data):
                    return
                self.lost("no record begins here")
                self.search(0, last)
                if not self.data.startswith(self.marker):
                    return
            try:
                r = self.parse(self.data, last)
            except (NeedsMore, Failed) as e:
                if isinstance(e, NeedsMore) and (e.guess or self.at + e.size <= self.total):
                    self.needed = min(e.size, self.total - self.at)
                    return
                self.lost(e.reason if isinstance(e, Failed) else "cut short")
                self.search(1, last)
                if not self.data.startswith(self.marker):
                    return
                continue
            if r.headers:
                self.closed()
                self.found.append((self.at, r))
            self.drop(r.length)
        if last:
            self.closed()

    def search(self, lo: int, last: bool) -> None:
        """Go to the next marker from ``lo`` on, or to the end, where the beginning of one may stand."""
        at = self.data.find(self.marker, lo)
        self.drop(at if at >= 0 else len(self.data) if last else max(lo, len(self.data) - len(self.marker) + 1))
        if last and not self.data:
            self.closed()


READ = (
    "path string, offset long, length long, kind string, reason string, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary, headers map<string,string>"
)
_TYPES = [
    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()), ("reason", pa.string()), ("record_type", pa.string()),
    ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()), ("headers", pa.map_(pa.string(), pa.string())),
]


def rows_of(path: str, found: list[tuple], whole: bool) -> Iterator[dict]:
    for at, *what in found:
        if len(what) == 2:
            yield {"path": path, "offset": at, "length": what[0], "kind": "gap", "reason": what[1]}
        else:
            r, h = what[0], what[0].headers
            yield {
                "path": path, "offset": at, "length": r.length, "kind": "record", "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"), "refers_to": h.get("warc-refers-to"),
                "target_uri": h.get("warc-target-uri"), "payload_bytes": r.payload_bytes, "payload_digest": r.digest, "payload": r.payload if whole else None, "headers": list(h.items()) if whole else None,
            }


def read_archives(spark: SparkSession, path: str, compressed: bool = False, whole: bool = True) -> DataFrame:
    """path, offset, length, kind, reason, record_type, record_id, refers_to, target_uri, payload_bytes, payload_digest, payload, headers.

    A row of kind ``record`` for every good record and one of kind ``gap`` for every stretch of bytes that no
    good record holds, with the reason of its first failed check; their lengths add up to the file's size, but
    for empty gzip members. A record is good if its version line, header, length, trailer and digests hold, and
    with ``compressed`` its gzip member's checksum. After a failed check the search goes on at the next marker, so that
    later records are recovered; one that a record's payload only contains is not read. payload and headers are null
    unless ``whole``. Files named ``.gz`` would be unpacked by the text source on the way: they are read
    in one part each and must fit in a task's memory; all others come in parts of any file's size.
    """
    marker = MEMBER if compressed else PLAIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, salvage, size, known = None, None, 0, 0

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(list(rows_of(path, found, whole)), pa.schema(_TYPES))

        def finish() -> Iterator[pa.RecordBatch]:
            if salvage:
                salvage.feed(marker if size + len(marker) <= known else b"", last=True)  # a marker at the very end opens no part
                yield out(salvage.found)

        for b in batches:
            for name, total, data in zip(b.column("path").to_pylist(), b.column("size").to_pylist(), b.column("value"), strict=True):
                data = data.as_py() or b""
                if name != path:
                    yield from finish()
                    path, salvage, size, known = name, Salvage(marker, total), 0, total
                elif not name.lower().endswith(".gz"):
                    data = marker + data
                size += len(data)
                salvage.feed(data)
                if len(salvage.found) >= 1000 or whole and salvage.found:
                    yield out(salvage.found)
                    salvage.found = []
        yield from finish()

    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")]
    if path.lower().endswith(".gz"):
        parts = spark.read.format("binaryFile").load(path).select(*place, F.col("content").alias("value"))
    else:
        parts = spark.read.options(lineSep=marker.decode("latin-1"), encoding="ISO-8859-1").text(path).select(*place, F.col("value").cast("binary").alias("value"))
    return parts.repartition("path").sortWithinPartitions("path", "start", "n").mapInArrow(run, READ)


def page_of(identifier: str | Column) -> Column:
    """page_id in a record id that ``write_archives`` gave."""
    text = F.regexp_extract(identifier, r"^<urn:page:(-?\d+):", 1)
    return F.when(text != "", text.cast("long"))


def archived(pages: DataFrame, least: int = 0, compress: bool = False) -> DataFrame:
    """The records of pages as read back from archives written below the shared checkpoint folder; cases as in ``write_archives``."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/archive-{uuid.uuid4().hex}"
    write_archives(pages, path, least, compress)
    return read_archives(spark, path, compress, whole=False)
