"""WARC archives: a writer with revisit records and a reader that salvages damage.

Writing: pages with equal payloads share a digest; the one with the smallest id is the
response, the others revisit it. Digests and ids alone are grouped; the groups that
have a copy are stored and joined back, a join that Spark splits where one payload has
very many pages. Each record is a gzip member of its own, with digests of block and
payload. Spark's text sink writes the archives: a member ends in the high byte of its
length, which is zero for members of less than 16 MiB, so this zero byte serves as the
sink's separator. A longer record is written as several members in a row.

Reading: each archive is read as bytes, member after member. A record is good if its
members inflate with the right checksum, its version line, headers and length hold, and
its block digest agrees. After a failed check the reader looks for the next place where
a member inflates to a version line (in plain archives: the next version line), goes on
there, and reports the bytes between as a gap with the reason. Nothing is skipped
silently. Where only the content of a record is bad, and another record or the end of the
archive stands where its length says, the gap is that record: a record quoted in its
payload is none of the archive's. Where the length is wrong too, such a quotation is found
as a record. An archive must fit a worker's memory: the writer begins another file after
``file_bytes`` packed bytes or ``FILE_RECORDS`` records, so a file is longer by at most one record.

Null payloads are empty. An empty table gives no archive and no record. Columns besides
the three named ones do not matter. Rows without an id revisit the smallest id of equal payloads like others, and are the response only where no copy has an id. Of rows that
share the smallest id, one is the response. Null urls give an empty target.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import stored
from lexweave.session import scratch_path

VERSION = b"WARC/1.1"
MEMBER = 8 << 20  # most bytes of a record in one member
FILE_RECORDS = 2_000
FILE_BYTES = 64 << 20  # packed
MAGIC = b"\x1f\x8b\x08"
ROW_NAMES = ["page_id", "url", "html", "sha", "first", "revisit"]
RECORD_SCHEMA = (
    "kind string, file string, offset long, length long, reason string, warc_type string, page_id long, "
    "target string, refers_to_page long, payload_bytes long, payload_digest string, payload binary"
)
RECORD_ARROW = pa.schema([
    ("kind", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("reason", pa.string()), ("warc_type", pa.string()), ("page_id", pa.int64()), ("target", pa.string()),
    ("refers_to_page", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary()),
])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def clean(value: str | None) -> str:
    """A header value without line ends and other control characters."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def record(page: int | None, url: str | None, payload: bytes, sha: str, revisit: bool, refers: int | None) -> bytes:
    """One record; a revisit keeps the response's HTTP headers and no payload."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean(url)}",
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.insert(5, f"WARC-Refers-To: {page_urn(refers)}")
        lines.insert(6, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(data: bytes) -> bytes:
    """Gzip members of at most ``MEMBER`` bytes each."""
    packed = []
    for start in range(0, len(data), MEMBER):
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed.append(squeeze.compress(data[start : start + MEMBER]) + squeeze.flush())
    return b"".join(packed)


def with_records(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """Which record each page becomes: its digest, ``revisit`` and the page it refers to."""
    source = pages.select(
        quoted(page_id).cast("long").alias("page_id"),
        quoted(url).cast("string").alias("url"),
        F.coalesce(quoted(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1(F.encode("html", "UTF-8")))
    groups = source.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    copied = stored(groups.where("copies > 1").drop("copies"), "payloads")
    return source.join(copied.withColumn("copied", F.lit(True)), "sha", "left")


def write_pages(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    path: str | None = None,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write the archives, below the shared checkpoint folder by default; returns their folder."""
    path = path or scratch_path(pages.sparkSession, "warc")
    first = F.col("page_id").eqNullSafe(F.col("first"))
    revisit = F.coalesce(F.col("copied") & ~first, F.lit(False))
    rows = with_records(pages, page_id, url, html).select("page_id", "url", "html", "sha", "first", revisit.alias("revisit"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = held = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out, parts = [], []
                rows = batch.slice(start, 64).rename_columns(ROW_NAMES).to_pylist()
                for row in rows:
                    sha = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                    data = record(
                        row["page_id"], row["url"], row["html"].encode(), sha, row["revisit"], row["first"]
                    )
                    if held >= file_bytes:
                        part, held = part + 1, 0
                    out.append(members(data)[:-1])
                    parts.append(part)
                    held += len(out[-1]) + 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(parts, pa.int32())], ["value", "part"])

    packed = rows.mapInArrow(pack, "value binary, part int").select(F.col("value").cast("string"), "part")
    # A task's parts are files of their own, one after the other.
    writer = packed.write.partitionBy("part").option("lineSep", "\x00")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return path


class Damage(ValueError):
    """A failed check; the text is the gap's reason, ``end`` where the record says that it ends."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def inflated(data: memoryview, at: int) -> tuple[bytes, int]:
    """The member at an offset and where it ends."""
    worker = zlib.decompressobj(31)
    out, size, place = [], 4096, at
    try:
        while not worker.eof:
            if place >= len(data):
                raise Damage("member is cut off")
            part = data[place : place + size]
            out.append(worker.decompress(part))
            place += len(part)
            size = min(2 * size, 1 << 20)
    except zlib.error as error:
        raise Damage(f"member does not inflate: {error}") from None
    return b"".join(out), place - len(worker.unused_data)


def begins(data: memoryview, at: int) -> bool:
    """Whether a version line is at an offset, plain or as the start of a member."""
    if data[at : at + 3] == MAGIC:
        try:
            return zlib.decompressobj(31).decompress(data[at : at + 4096], 16).startswith(b"WARC/")
        except zlib.error:
            return False
    return bytes(data[at : at + 7]) == b"WARC/1."


MARK = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def next_start(data: memoryview, after: int) -> int:
    """The next offset where a record may begin, or the end."""
    for found in MARK.finditer(data, after):
        if begins(data, found.start()):
            return found.start()
    return len(data)


def headers_of(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line without a colon")
        found[name.decode("latin-1").strip().lower()] = value.decode(errors="replace").strip()
    return found


def next_record(data: memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and where it ends."""
    packed = data[at : at + 3] == MAGIC
    if packed:
        text, end = inflated(data, at)
    else:
        text, end = bytes(data[at : at + 65536]), at
    if not text.startswith(b"WARC/1."):
        raise Damage("no version line")
    close = text.find(b"\r\n\r\n")
    while close < 0 and not packed and at + len(text) < len(data):
        # Longer headers: look on from where the blank line may have begun.
        known = max(0, len(text) - 3)
        text = bytes(data[at : at + 4 * len(text)])
        close = text.find(b"\r\n\r\n", known)
    if close < 0:
        raise Damage("headers do not end")
    headers = headers_of(text[:close])
    if not re.fullmatch("[0-9]{1,18}", headers.get("content-length", "")):
        raise Damage("no length")
    size = close + 4 + int(headers["content-length"]) + 4
    if not packed:
        if at + size > len(data):
            raise Damage("record is cut off")
        text, end = bytes(data[at : at + size]), at + size
    while len(text) < size:
        if end >= len(data) or begins(data, end):
            raise Damage("record is cut off")
        more, end = inflated(data, end)
        text += more
    if text[size - 4 :] != b"\r\n\r\n":
        raise Damage("record does not end where its length says")
    block = text[close + 4 : size - 4]
    told = headers.get("warc-block-digest", "").removeprefix("sha1:")
    if told and told != digest(block):
        raise Damage("block digest differs", end)
    return headers, block, end


def parsed(headers: dict[str, str], block: bytes, end: int) -> dict[str, object]:
    """The columns of a record; raises where the payload's digest differs."""
    number = lambda urn: int(m[1]) if (m := re.fullmatch("<urn:page:(-?[0-9]+)>", urn)) else None
    head, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size: int | None = len(payload)
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})", head)
        size = int(length[1]) if length else None
    elif told and told != digest(payload):
        raise Damage("payload digest differs", end)
    return {
        "warc_type": kind,
        "page_id": number(headers.get("warc-record-id", "")),
        "target": headers.get("warc-target-uri"),
        "refers_to_page": number(headers.get("warc-refers-to", "")),
        "payload_bytes": size,
        "payload_digest": told or digest(payload),
        "payload": None if kind == "revisit" else payload,
    }


def framed(data: memoryview, at: int) -> bool:
    """Whether a record that ends where its length says stands at an offset, or nothing any more."""
    if at == len(data):
        return True
    try:
        next_record(data, at)
    except Damage as damage:
        return damage.end is not None
    return True


def salvaged(content: bytes | pa.Buffer) -> Iterator[dict[str, object]]:
    """Records and gaps of one archive, in order; together they cover every byte."""
    data = memoryview(content).cast("B")
    at = 0
    while at < len(data):
        try:
            headers, block, end = next_record(data, at)
            row = {"kind": "record", "offset": at, "length": end - at} | parsed(headers, block, end)
        except Damage as damage:
            end = damage.end if damage.end and framed(data, damage.end) else next_start(data, at + 1)
            row = {"kind": "gap", "offset": at, "length": end - at, "reason": str(damage)}
        yield row
        at = end


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps (``kind``) of all archives in a folder."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows: list[dict[str, object]] = []
                held = 0
                for row in salvaged(content.as_buffer()):
                    rows.append(row | {"file": name.as_py()})
                    held += len(row.get("payload") or b"") + 200
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    return files.mapInArrow(each, RECORD_SCHEMA)
