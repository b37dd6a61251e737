"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

A record is a gzip member of its own. The writer's tasks write files of bounded
size; the reader streams them and keeps one record in memory. What a damaged or hostile file makes
it keep is bounded too: a record may claim ``MOST_BYTES`` of content at most, a member is inflated no
further than its record claims.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.llm.files import new_file, open_input, open_output, shared_dir
from perron.llm.tables import saved, task_count
from perron.operators.joins import split_join

# Fixed values of the format.
VERSION = b"WARC/1.1"
GZIP_MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

FILE_BYTES = 64 << 20
# The longest content that a record may claim, and the longest header.
MOST_BYTES, HEADER_BYTES = 1 << 30, 1 << 20
READ, STEP, INFLATED = 1 << 17, 1 << 13, 1 << 16
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
BEGINNING = re.compile(re.escape(GZIP_MAGIC) + b"|" + VERSION_LINE.pattern)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}").urn


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, not compressed. A revisit keeps the HTTP header, which states the length of the full payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{record_id(page_id) if page_id is not None else uuid.uuid4().urn}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\r\n]+", " ", url) if url else None,
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "WARC-Block-Digest": f"sha1:{digest_of(block)}",
        "WARC-Page-ID": page_id,
        "WARC-Profile": REVISIT_PROFILE if refers_to is not None else None,
        "WARC-Refers-To": f"<{record_id(refers_to)}>" if refers_to is not None else None,
        "WARC-Refers-To-Page-ID": refers_to,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(record: bytes, level: int = 6) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


@dataclass
class Gap:
    """Bytes of a file that belong to no sound record, and why."""

    start: int
    length: int
    reason: str


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        _, mark, rest = self.block.partition(b"\r\n\r\n")
        return rest if mark else self.block

    def http_length(self) -> int | None:
        found = re.search(rb"(?im)^content-length:\s*(\d+)", self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else None


@dataclass
class _Buffer:
    """A window on a stream: ``data`` begins at byte ``at`` of the file."""

    stream: BinaryIO
    data: bytearray = field(default_factory=bytearray)
    at: int = 0
    over: bool = False

    def more(self, size: int = READ) -> bool:
        got = b"" if self.over else self.stream.read(size)
        self.over = not got
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.at += n


def read_records(stream: BinaryIO, most_bytes: int = MOST_BYTES) -> Iterator[Record | Gap]:
    """The sound records of an archive, gzip members or plain, and the gaps between them.

    A record must have a version line, a content length that the data hold, a closing
    blank line, and digests (where given) that fit. After a failed check the
    reader looks for the next member or version line behind the place where the
    broken record began, goes on from there, and reports the bytes between. A record that
    claims more than ``most_bytes`` of content is such a gap and is not waited for.
    """
    buffer = _Buffer(stream)
    gap_start, reason = None, ""
    while True:
        while len(buffer.data) < 16 and buffer.more():
            pass
        if not buffer.data:
            break
        start = buffer.at
        record, used, why = (_member if buffer.data.startswith(GZIP_MAGIC) else _plain)(buffer, most_bytes)
        if record is not None:
            if gap_start is not None:
                yield Gap(gap_start, start - gap_start, reason)
                gap_start = None
            record.offset = start
            yield record
            buffer.drop(used)
            continue
        if gap_start is None:
            gap_start, reason = start, why
        _seek_next(buffer)
    if gap_start is not None:
        yield Gap(gap_start, buffer.at - gap_start, reason)


def _seek_next(buffer: _Buffer) -> None:
    """Moves to the next member or version line behind the first byte."""
    at = 1
    while True:
        if found := BEGINNING.search(buffer.data, at):
            place = found.start()
            del found  # a match holds the buffer, which could not shrink
            buffer.drop(place)
            return
        keep = 16  # a mark may go on in the next read
        if len(buffer.data) > keep:
            buffer.drop(len(buffer.data) - keep)
            at = 1
        if not buffer.more():
            buffer.drop(len(buffer.data))
            return


def _member(buffer: _Buffer, most: int) -> tuple[Record | None, int, str]:
    unpack, out, fed, head, most_fed = zlib.decompressobj(31), bytearray(), 0, None, 2 * HEADER_BYTES
    try:
        while not unpack.eof:
            piece = unpack.unconsumed_tail
            if not piece and (fed < len(buffer.data) or buffer.more()):
                piece = bytes(buffer.data[fed : fed + STEP])
                fed += len(piece)
            got = unpack.decompress(piece, INFLATED)
            out += got
            if not piece and not got and not unpack.eof:
                return None, 0, "truncated member"
            if head is None:
                head, why = _head(out, most)
                if why not in ("", "more"):
                    return None, 0, why
                if head is not None:
                    # packed data are hardly ever longer than the data
                    most_fed += 2 * head.end
            if head is not None and len(out) > head.end:
                return None, 0, "member goes on after its record"
            if fed > most_fed:
                return None, 0, "member longer than its record"
    except zlib.error as error:
        return None, 0, f"broken member: {error}"
    if head is None or len(out) < head.end:
        return None, 0, "truncated record"
    record, why = _checked(out, head)
    return record, fed - len(unpack.unused_data), why


def _plain(buffer: _Buffer, most: int) -> tuple[Record | None, int, str]:
    if not VERSION_LINE.match(buffer.data):
        return None, 0, "no version line"
    head = None
    while True:
        if head is None:
            head, why = _head(buffer.data, most)
            if why not in ("", "more"):
                return None, 0, why
        if head is not None and len(buffer.data) >= head.end:
            record, why = _checked(buffer.data, head)
            return record, head.end, why
        if not buffer.more():
            return None, 0, "truncated record"


@dataclass
class _Head:
    """The header of a record: its block goes from ``begin`` to four bytes before ``end``."""

    headers: dict[str, str]
    begin: int
    end: int


def _head(data: bytearray, most: int) -> tuple[_Head | None, str]:
    """The header at the beginning of ``data``; ``more`` as reason if it goes on behind ``data``."""
    if len(data) < 16:
        return None, "more"
    if not VERSION_LINE.match(data):
        return None, "no version line"
    end = data.find(b"\r\n\r\n", 0, HEADER_BYTES)
    if end < 0:
        return None, "more" if len(data) < HEADER_BYTES else "endless header"
    headers = {}
    for line in bytes(data[:end]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, "broken header line"
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]+", length):
        return None, "no content length"
    if len(length) > 18 or int(length) > most:
        return None, f"content length above {most}"
    return _Head(headers, end + 4, end + 4 + int(length) + 4), ""


def _checked(data: bytearray, head: _Head) -> tuple[Record | None, str]:
    """The record of ``data``, which hold all of it, if its end and its digests are right."""
    block = bytes(data[head.begin : head.end - 4])
    if data[head.end - 4 : head.end] != b"\r\n\r\n":
        return None, "no blank line after the block"
    headers, record = head.headers, Record(0, head.headers, block)
    if headers.get("warc-block-digest", "").startswith("sha1:") and headers["warc-block-digest"][5:] != digest_of(block):
        return None, "block digest differs"
    payload = headers.get("warc-payload-digest", "")
    if payload.startswith("sha1:") and headers.get("warc-type") != "revisit" and payload[5:] != digest_of(record.payload()):
        return None, "payload digest differs"
    return record, ""


# ---- tables -----------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as rows page_id, url, payload (binary), refers_to.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with
    the smallest page_id is written in full, the others refer to it. A page without
    page_id cannot be referred to and is always written in full; rows that repeat
    a page_id with the same payload are written in full each.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256)))
    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # only payloads that occur again are looked up
    firsts = firsts.filter("digest is not null and n > 1").drop("n")
    # the small side has an exchange of its own, so that a payload of very many pages can be split
    rows = split_join(rows, firsts, ["digest"], "left")
    return rows.select("page_id", "url", "payload", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes rows (page_id, url, payload, refers_to) and returns the manifest (file, records, bytes).

    Every task writes files of its own, none longer than ``file_bytes`` but for one
    record; the manifest, a stored table, names those of the attempts that counted.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*columns):
                if out is None:
                    name, records, size = new_file(folder, ".warc.gz"), 0, 0
                    out = open_output(name)
                member = gzip_member(record_bytes(page_id, url, payload, refers_to))
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield _manifest_row(name, records, size)
        if out is not None:
            out.close()
            yield _manifest_row(name, records, size)

    return saved(rows.mapInArrow(written, "file string, records bigint, bytes bigint"), "warc-manifest")


def _manifest_row(name: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"file": [name], "records": [records], "bytes": [size]})


RECORD_SCHEMA = (
    "file string, offset bigint, gap_bytes bigint, gap_reason string, record_type string, page_id bigint, url string, "
    "payload binary, payload_bytes bigint, payload_digest string, refers_to bigint"
)


def read_archives(spark: SparkSession, files: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Records and quarantined gaps of the archives named in ``files`` (file).

    A row is a record (gap_bytes null) or a gap (gap_bytes and gap_reason, all else
    but file and offset null). payload_bytes and payload_digest are those of the
    full payload, also for revisits, whose payload is null. Files are dealt out to
    tasks and streamed; records that claim more than ``most_bytes`` of content come as gaps.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows, size = [], 0
                with open_input(name) as stream:
                    for item in read_records(stream, most_bytes):
                        rows.append(_row(name, item))
                        size += len(rows[-1]["payload"] or b"")
                        if size > 4 << 20 or len(rows) >= 2000:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    dealt = files.select("file").repartition(task_count(spark), F.col("file"))
    return dealt.mapInArrow(read, RECORD_SCHEMA)


_ARROW = pa.schema(
    [
        ("file", pa.string()), ("offset", pa.int64()), ("gap_bytes", pa.int64()), ("gap_reason", pa.string()),
        ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def _row(name: str, item: Record | Gap) -> dict:
    row = dict.fromkeys(_ARROW.names)
    if isinstance(item, Gap):
        return row | {"file": name, "offset": item.start, "gap_bytes": item.length, "gap_reason": item.reason}
    head = item.headers
    number = lambda key: int(head[key]) if re.fullmatch(r"-?\d+", head.get(key, "")) else None
    revisit = head.get("warc-type") == "revisit"
    payload = None if revisit else item.payload()
    return row | {
        "file": name,
        "offset": item.offset,
        "record_type": head.get("warc-type"),
        "page_id": number("warc-page-id"),
        "url": head.get("warc-target-uri"),
        "payload": payload,
        "payload_bytes": item.http_length() if revisit else len(payload),
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "refers_to": number("warc-refers-to-page-id"),
    }


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back.

    One row per row of ``pages``; null html is an empty payload, null urls have no
    target header. An empty table gives no archives and no rows.
    """
    spark = pages.sparkSession
    manifest = write_archives(with_revisits(pages, least_bytes), shared_dir(spark, "warc"))
    return read_archives(spark, manifest)
