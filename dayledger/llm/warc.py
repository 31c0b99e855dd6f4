"""WARC archives: pages written as records, and a reader that salvages what damage has left.

Writing. A page is one gzip member that holds one record, so a reader can begin at any member.
Pages with equal payloads are written once, by the page with the largest id; the others are
revisits that name its record and repeat its HTTP header, content length included, without the
payload. Spark's text sink writes the bytes: the separator it puts after each row is the zero
byte that ends the length field of every member below 16 MiB, and is padding behind a longer one,
as gzip readers skip zeros between members.

Reading. A file is read by one task from its start. At each position there must be a gzip member
or a version line, and a record must pass its checks: member checksum and length, complete header
block with type, id and content length, the two line ends behind the block, and the block and payload digests
where the header has them. After a failed check the reader searches for the next member or version
line that passes, goes on from there, and logs the bytes in between with the reason as a
quarantined gap. Records in the sound head of a damaged member are kept if their block digest
says that they are whole; the member is a gap all the same. So records, gaps and the padding
between them cover the file.

Archives hold at most `RECORDS` records, so a task's memory is bounded by one archive and its
largest record. No page is compared with another: equal payloads meet in an aggregation of their
digests, and the rows of a common payload are spread over copies of its one row.

Defined results: null html is an empty payload and null urls an empty target; an empty payload is a
payload like any other. Of rows that repeat an id and payload all are responses if the id is the
payload's largest. Rows with a null id are revisits where the payload has an id, else responses.
Columns other than id, url and html are not written. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm.scratch import Scratch

RECORDS = 2_000
#: Copies of the row of a payload that several pages share.
COPIES = 32
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Names and line forms of the archive format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION_LINE = re.compile(rb"WARC/[0-9]+\.[0-9]+\r?\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/[0-9]+\.[0-9]+\r?\n")
HEADER_END = re.compile(rb"\r?\n\r?\n")
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
#: A longer header is damage.
MAX_HEADER = 1 << 20
CRAWL_DATE = "1970-01-01T00:00:00Z"

SALVAGED = (
    "path string, offset bigint, length bigint, record_type string, record_id string, refers_to string, target_uri string, "
    "headers map<string,string>, payload binary, payload_bytes bigint, payload_digest string, gap_reason string"
)
ROWS = pa.schema([
    ("path", pa.string()),
    ("offset", pa.int64()),
    ("length", pa.int64()),
    ("record_type", pa.string()),
    ("record_id", pa.string()),
    ("refers_to", pa.string()),
    ("target_uri", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())),
    ("payload", pa.binary()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("gap_reason", pa.string()),
])
ROW_NAMES = ROWS.names


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def one_line(text: str) -> str:
    """A header value: line ends would end the header, so they become spaces."""
    return re.sub(r"[\r\n]+", " ", text)


def build_record(record_id: str, url: str, payload: bytes, refers_to: str | None, payload_digest: str) -> bytes:
    """One uncompressed record. A revisit has the HTTP header of the page but not its payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", CRAWL_DATE),
        ("WARC-Target-URI", one_line(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")] if refers_to else []),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + END


def gzip_member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


@dataclass(frozen=True)
class Found:
    """A record, or a gap with its reason, at some bytes of a file."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] | None = None
    block: bytes = b""


class Damaged(Exception):
    """A check that failed, and the whole records found before it did."""

    def __init__(self, reason: str, found: list[Found] | None = None):
        super().__init__(reason)
        self.found = found or []


def parse_headers(text: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines continue the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in text.decode("utf-8", "replace").replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise Damaged("header line without a name")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields


def digest_matches(named: str | None, data: bytes) -> bool | None:
    """Whether a `sha1:` digest in base32 or hex is that of data; None for no or another digest."""
    algorithm, _, value = (named or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    own = hashlib.sha1(data, usedforsecurity=False).digest()
    return value.upper() == base64.b32encode(own).decode() or value.lower() == own.hex()


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and payload of a block; a block of another kind is its own payload."""
    end = HEADER_END.search(block, 0, MAX_HEADER) if block.startswith(b"HTTP/") else None
    if not end:
        return {}, block
    _, _, fields = block[: end.start()].partition(b"\n")
    try:
        return parse_headers(fields), block[end.end() :]
    except Damaged:
        return {}, block[end.end() :]


def read_record(data: bytes, at: int) -> Found:
    """The record whose version line is at `at`, or the check it does not pass."""
    version = VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("neither a member nor a version line")
    end = HEADER_END.search(data, version.end() - 1, version.end() + MAX_HEADER)
    if not end:
        raise Damaged("header has no end")
    headers = parse_headers(data[version.end() : end.start()])
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        raise Damaged("no content length")
    if not headers.get("warc-type") or not headers.get("warc-record-id"):
        raise Damaged("no record type or id")
    to = end.end() + int(size)
    if to + len(END) > len(data):
        raise Damaged("record is cut short")
    if data[to : to + len(END)] != END:
        raise Damaged("record does not end where its length says")
    block = data[end.end() : to]
    if digest_matches(headers.get("warc-block-digest"), block) is False:
        raise Damaged("block digest does not match")
    if headers.get("warc-type") == "response" and digest_matches(headers.get("warc-payload-digest"), split_http(block)[1]) is False:
        raise Damaged("payload digest does not match")
    return Found(at, to + len(END) - at, None, headers, block)


def inflate(data: bytes, at: int) -> tuple[int, bytes, str | None]:
    """(end, content, failure) of the member at `at`; after a failure the content is its sound head."""
    stream, parts, view, step = zlib.decompressobj(31), [], memoryview(data), 1 << 16
    try:
        for begin in range(at, len(data), step):
            parts.append(stream.decompress(view[begin : begin + step]))
            if stream.eof:
                return min(begin + step, len(data)) - len(stream.unused_data), b"".join(parts), None
    except zlib.error as failure:
        return len(data), b"".join(parts), re.sub(r"^Error -?[0-9]+ while decompressing data: ", "", str(failure))
    return len(data), b"".join(parts), "member is cut short"


def read_member(data: bytes, at: int) -> tuple[int, list[Found]]:
    """End of the member at `at` and what it holds; inner gaps have no length in the file."""
    end, content, failure = inflate(data, at)
    inside = list(salvage(content))
    records = [f for f in inside if f.reason is None]
    if failure:
        whole = [f for f in records if digest_matches(f.headers.get("warc-block-digest"), f.block)]
        raise Damaged(failure, [replace(f, offset=at, length=0) for f in whole])
    if content and not records:
        raise Damaged(f"member holds no record: {inside[0].reason}" if inside else "member holds no record")
    # The member's bytes are counted with the first of its records.
    lengths = [end - at] + [0] * len(inside)
    placed = [replace(f, offset=at, length=lengths.pop(0) if f.reason is None else 0) for f in inside]
    return end, [replace(f, reason=f"inside a member: {f.reason}") if f.reason else f for f in placed]


def salvage(data: bytes) -> Iterator[Found]:
    """Every record that passes its checks, and the gaps between them, in file order."""
    at, gap, reason = 0, 0, None
    while at < len(data):
        if reason is None and data[at] in b"\0\r\n":
            at += 1  # padding between records
            continue
        try:
            if data.startswith(MEMBER, at):
                end, found = read_member(data, at)
            else:
                record = read_record(data, at)
                end, found = at + record.length, [record]
        except Damaged as failure:
            yield from failure.found
            if reason is None:
                gap, reason = at, str(failure)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if reason is not None:
            yield Found(gap, at - gap, reason)
            reason = None
        yield from found
        at = end
    if reason is not None:
        yield Found(gap, len(data) - gap, reason)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Python workers get at most `rows` rows at a time in what is written inside."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def record_name(key: str | None) -> str:
    """Record id of a page; the same id in every run. A null key has the bare name."""
    return "urn:page" if key is None else f"urn:page:{quote(key, safe='')}"


def with_holder(pages: DataFrame) -> DataFrame:
    """Pages (key, url, payload) with the SHA-1 of the payload and the largest key that has it.

    Only payloads of several pages are looked up, each in as many copies as share its pages out.
    """
    hashed = pages.withColumn("sha", F.sha1("payload"))
    shared = hashed.groupBy("sha").agg(F.max("key").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = shared.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    dealt = hashed.withColumn("copy", F.pmod(F.hash("key", "url"), F.lit(COPIES)))
    return dealt.join(copies, ["sha", "copy"], "left").drop("copy")


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The gzip member of each page, without its last byte where the writer's separator is that byte."""
    for batch in batches:
        out = []
        for page in batch.to_pylist():
            refers = page["holder"] is not None and page["key"] != page["holder"]
            digest = base64.b32encode(bytes.fromhex(page["sha"])).decode()
            name, holder = record_name(page["key"]), record_name(page["holder"]) if refers else None
            record = build_record(name, page["url"] or "", page["payload"], holder, digest)
            member = gzip_member(record)
            out.append(member[:-1] if len(record) < 1 << 24 else member)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    records: int = RECORDS,
) -> None:
    """Write every page as a record, at most `records` in an archive, below a new folder `path`."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    held = with_holder(rows).withColumns({"key": F.col("key").cast("string"), "holder": F.col("holder").cast("string")})
    built = held.select("key", "holder", "url", "payload", "sha").mapInArrow(members, "member binary")
    with arrow_rows(pages.sparkSession, 200):
        writer = built.select(F.col("member").cast("string").alias("value")).write
        writer.option("lineSep", "\0").option("maxRecordsPerFile", records).text(path)


def record_row(path: str, found: Found, with_payload: bool) -> dict:
    """One output row of the reader."""
    row = dict.fromkeys(ROW_NAMES) | {"path": path, "offset": found.offset, "length": found.length, "gap_reason": found.reason}
    if found.reason is not None:
        return row
    headers = found.headers
    http, payload = split_http(found.block)
    row |= {
        "record_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id", "").strip("<>") or None,
        "refers_to": headers.get("warc-refers-to", "").strip("<>") or None,
        "target_uri": headers.get("warc-target-uri"),
        "headers": list(headers.items()),
    }
    if row["record_type"] == "revisit":
        # The payload lies in the record referred to; its size and digest are stated here.
        size, (algorithm, _, digest) = http.get("content-length", ""), headers.get("warc-payload-digest", "").partition(":")
        row["payload_bytes"] = int(size) if re.fullmatch("[0-9]{1,18}", size) else None
        row["payload_digest"] = digest if algorithm == "sha1" and digest else None
    else:
        row |= {"payload": payload if with_payload else None, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}
    return row


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps (`gap_reason` is not null) of all archives below `path`, as a written table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for found in salvage(content.as_buffer().to_pybytes()):
                    rows.append(record_row(name.as_py(), found, with_payload))
                    size += len(found.block) if with_payload else 200
                    if size > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, ROWS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, ROWS)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    keep = Scratch(files)
    with arrow_rows(spark, 1):
        return keep(files.mapInArrow(read, SALVAGED), "salvaged")


def records(read: DataFrame) -> DataFrame:
    return read.where(F.col("gap_reason").isNull()).drop("gap_reason")


def gaps(read: DataFrame) -> DataFrame:
    """The quarantined bytes: path, offset, length and the check that failed first."""
    return read.where(F.col("gap_reason").isNotNull()).select("path", "offset", "length", "gap_reason")


def page_key(record_id: str) -> Column:
    """Key of the page that a record id column names, as text; null for any other record."""
    found = F.regexp_extract(record_id, "^urn:page:(.*)$", 1)
    return F.when(F.col(record_id).startswith("urn:page:"), F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))
