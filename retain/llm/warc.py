"""WARC archives: a writer that marks repeated payloads as revisits, and a splittable reader.

Each record is one gzip member. The reader deals byte ranges of the archives to tasks. A task
searches its range for the gzip magic, accepts a candidate member only if it decodes to a WARC
header, read as far as its blank line, and owns every record that starts inside its range, reading
past the end to finish it. Archives that others wrote are read too: any record type, any record id;
field names in any case. A response's payload is its HTTP body as stored, a revisit has none, any
other record's payload is its whole block.

Writing tasks put files of their own in a shared folder and return them as rows; only files that
a finished task returned are read, so a repeated task leaves nothing that counts twice. Files
are reached through `pyarrow.fs`, so the folder may be any store that it knows.

Defined cases: null html is an empty payload; null and odd urls are written percent-encoded; a
null page_id is written as an empty id and read back as null, and revisits the group's smallest
page_id if there is one; rows that share that page_id are all responses; a record of another
writer has no page_id, and null for each field that it lacks; an empty table gives no archive and no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retain.llm.common import attach, materialize

MIN_REVISIT = 100
SPLIT_BYTES = 64 << 20
FILE_BYTES = 1 << 30
CHUNK = 1 << 20
LOOK = 1 << 16  # bytes that must follow a candidate, or the end of the file, before it is judged
MAGIC = b"\x1f\x8b\x08"
WARC = b"WARC/1."
PAGE = "<urn:page:"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "page_id long, url string, record_type string, refers_to long, digest string, length long, payload binary, "
    "record_id string, refers_to_id string"
)


# Writing --------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, length, and refers_to where the record revisits another."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(
        "page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("length")
    )
    groups = (
        keyed.filter(F.col("length") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )
    found = attach(keyed, groups, "digest", "copies", F.xxhash64("page_id", "url"))
    return found.select(
        "page_id", "url", "html", "digest", "length", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def record_bytes(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None) -> bytes:
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    block = HTTP % len(html) + (b"" if refers_to is not None else html)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
        "WARC-Date: 2000-01-01T00:00:00Z",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=URL_SAFE)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


URL_SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def archive(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    # Readers find the store by the scheme; a local path needs none.
    top = root if isinstance(store, fs.LocalFileSystem) else folder.rstrip("/")
    out, done = None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "refers_to")]
        for i, (page_id, url, digest, refers_to) in enumerate(zip(*columns)):
            if out is None:
                name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                out = store.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None)  # members are compressed one by one
            html = batch.column("html")[i].as_py() or ""
            member = gzip_member(record_bytes(page_id, url, html.encode(), digest, refers_to))
            out.write(member)
            size, count = size + len(member), count + 1
            if size >= file_bytes:
                out.close()
                done.append((f"{top}/{name}", size, count))
                out = None
    if out is not None:
        out.close()
        done.append((f"{top}/{name}", size, count))
    if done:
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "bytes", "records"), x)) for x in done])


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of `pages` and return the files: (file, bytes, records)."""
    files = with_revisits(pages, min_bytes).mapInArrow(lambda batches: archive(batches, folder, file_bytes), "file string, bytes long, records long")
    return materialize(files, "archives")


# Reading --------------------------------------------------------------------------------


class Window:
    """A stretch of a file that grows at its end and is cut at its start."""

    def __init__(self, source, start: int):
        self.source, self.start, self.data, self.ended = source, start, b"", False
        source.seek(start)

    def fill(self, upto: int) -> None:
        """Have the bytes before file position `upto`, as far as the file goes."""
        parts, have = [], self.start + len(self.data)
        while have < upto and not self.ended:
            got = self.source.read(CHUNK)
            self.ended = not got
            parts.append(got)
            have += len(got)
        if parts:
            self.data += b"".join(parts)

    def drop(self, upto: int) -> None:
        self.data = self.data[upto - self.start :]
        self.start = upto

    def find(self, at: int, stop: int) -> int | None:
        """The first magic at or after `at` and before `stop`."""
        while at < stop:
            self.fill(at + CHUNK)
            found = self.data.find(MAGIC, at - self.start)
            if found >= 0:
                found += self.start
                return found if found < stop else None
            if self.ended:
                return None
            at = max(at, self.start + len(self.data) - len(MAGIC) + 1)
            self.drop(at)
        return None

    def is_record(self, at: int) -> bool:
        """Whether a member at `at` decodes to a WARC header, which may be of any length."""
        unpacker, head, pos, rest = zlib.decompressobj(31), b"", at, b""
        while b"\r\n\r\n" not in head and not unpacker.eof:
            if not rest:
                self.fill(pos + LOOK)
                rest = self.data[pos - self.start : pos - self.start + LOOK]
                pos += len(rest)
                if not rest:
                    return False
            try:
                head += unpacker.decompress(rest, 4096)
            except zlib.error:
                return False
            rest = unpacker.unconsumed_tail
            if head[: len(WARC)] != WARC[: len(head)]:
                return False
        return head.startswith(WARC) and b"\r\nwarc-type:" in head.partition(b"\r\n\r\n")[0].lower()

    def member(self, at: int) -> tuple[bytes, int]:
        """The decoded member at `at` and the position behind it; its checksum is verified."""
        unpacker, parts, pos = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            self.fill(pos + 1)
            piece = self.data[pos - self.start :]
            if not piece:
                raise ValueError(f"archive ends inside the record at {at}")
            parts.append(unpacker.decompress(piece))
            pos += len(piece) - len(unpacker.unused_data)
            self.drop(pos)
        return b"".join(parts), pos


def header_fields(head: bytes) -> dict[str, str]:
    """The fields of a header block by their names in lower case; the first of a repeated name counts."""
    found: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def page_of(record_id: str | None) -> int | None:
    """The page_id in a record id of this writer."""
    number = (record_id or "").removeprefix(PAGE).removesuffix(">")
    return int(number) if (record_id or "").startswith(PAGE) and number.lstrip("-").isdecimal() else None


def parse(member: bytes) -> dict:
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = header_fields(head)
    size, kind = fields.get("content-length", ""), fields["warc-type"]
    payload = rest[: int(size)] if size.isdecimal() else rest.removesuffix(b"\r\n\r\n")
    length = None
    if kind in ("response", "revisit") and payload.startswith(b"HTTP/"):
        http, _, payload = payload.partition(b"\r\n\r\n")
        stated = header_fields(http).get("content-length", "")
        length = int(stated) if stated.isdecimal() else None
    payload = None if kind == "revisit" else payload
    return {
        "page_id": page_of(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "digest": digest.removeprefix("sha256:") if (digest := fields.get("warc-payload-digest")) else None,
        "length": length if payload is None else len(payload), "payload": payload,
        "record_id": fields.get("warc-record-id"), "refers_to_id": fields.get("warc-refers-to"),
    }


def records_of(source, start: int, stop: int) -> Iterator[dict]:
    """The records that start in [start, stop)."""
    window, at = Window(source, start), start
    while (at := window.find(at, stop)) is not None:
        if not window.is_record(at):
            at += 1
            continue
        member, at = window.member(at)
        yield parse(member)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that start in the byte ranges (file, start, stop)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("digest", pa.string()), ("length", pa.int64()), ("payload", pa.binary()), ("record_id", pa.string()),
                        ("refers_to_id", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(row["file"])
            with store.open_input_file(path) as source:
                held, size = [], 0
                for record in records_of(source, row["start"], row["stop"]):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if len(held) == 1000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of `files` (file, bytes), one task per byte range."""
    root = files.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = root.withColumn("stop", F.least(F.col("start") + F.lit(split_bytes), "bytes"))
    n = min(max(ranges.count(), 1), 100_000)
    return ranges.repartition(n).mapInArrow(scan, RECORD)


def report(records: DataFrame) -> DataFrame:
    """The contract's row per record. Payloads are measured, revisits carry what they refer to."""
    measured = F.col("payload").isNotNull()
    return records.select(
        "page_id",
        F.when(measured, F.octet_length("payload").cast("long")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(measured, F.sha2(F.col("payload"), 256)).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )
