import gzip
import hashlib
import random

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import functions as F

from retain.llm import warc
from retain.llm.common import shared_path

PAGES = "page_id long, url string, html string, digest string, first string, file string"


def pages(spark, table):
    return spark.createDataFrame([(*r, "d", "f", "x") for r in table], PAGES)


def test_round_trip_over_small_ranges(spark):
    draw = random.Random(2)
    table = [(i, f"http://h/{i}?q=ä b", "".join(chr(draw.randrange(32, 900)) for _ in range(draw.randrange(0, 9000)))) for i in range(80)]
    table += [(100, None, None), (101, "", ""), (102, "u\r\nX: y", "short"), (103, "u", "short"), (None, "n", "z" * 200)]
    table += [(5, "u", "same " * 50), (3, "u", "same " * 50), (4, "u", "same " * 50), (3, "v", "same " * 50)]
    folder = shared_path(spark, "warc-test")
    files = warc.write(pages(spark, table), folder, file_bytes=60_000)
    read = warc.read(spark, files, split_bytes=997)
    back = {(r["page_id"], r["url"]): r for r in read.collect()}
    assert read.count() == len(table) == sum(r["records"] for r in files.collect())
    for i, _, html in table[:85]:
        (record,) = [r for (k, _), r in back.items() if k == i] if i not in (3, 4, 5) else [None]
        if record is not None:
            assert bytes(record["payload"]) == (html or "").encode()
    out = sorted((tuple(r) for r in warc.report(read).collect() if r["page_id"] in (3, 4, 5) and r["payload_bytes"] == 250), key=repr)
    body = hashlib.sha256(("same " * 50).encode()).hexdigest()
    assert out == sorted([(3, 250, body, "response", None)] * 2 + [(4, 250, body, "revisit", 3), (5, 250, body, "revisit", 3)], key=repr)


def test_archives_are_plain_gzip(spark):
    files = warc.write(pages(spark, [(1, "http://a", "<p>hi</p>")]), shared_path(spark, "warc-test"))
    with gzip.open(files.first()["file"]) as f:
        text = f.read().decode()
    assert text.startswith("WARC/1.1\r\n") and text.endswith("<p>hi</p>\r\n\r\n")


def test_magic_inside_a_payload_is_no_record():
    inner = warc.gzip_member(b"not a record" * 100)
    source = b"".join(warc.gzip_member(warc.record_bytes(i, "u", inner * 40, "d", None), level=0) for i in range(3))
    import io

    found = [r["page_id"] for a in range(0, len(source), 700) for r in warc.records_of(io.BytesIO(source), a, min(a + 700, len(source)))]
    assert found == [0, 1, 2]


def test_round_trip_in_a_store_with_a_scheme(monkeypatch, tmp_path):
    class Stores:
        """box://name/path lies in a folder; a path without a scheme is in no store."""

        @staticmethod
        def from_uri(uri):
            scheme, mark, path = uri.partition("://")
            if (scheme, mark) != ("box", "://"):
                raise ValueError(f"URI has empty scheme: {uri}")
            return pa_fs.SubTreeFileSystem(str(tmp_path), pa_fs.LocalFileSystem()), path

    monkeypatch.setattr(warc.fs, "FileSystem", Stores)
    table = [{"page_id": i, "url": f"http://h/{i}", "html": "x" * i, "digest": "d", "refers_to": None} for i in range(1, 6)]
    files = [r for b in warc.archive([pa.RecordBatch.from_pylist(table)], "box://bucket/key/", 300) for r in b.to_pylist()]
    assert len(files) > 1 and all(r["file"].startswith("box://bucket/key/") for r in files)
    ranges = [{"file": r["file"], "start": 0, "stop": r["bytes"]} for r in files]
    back = [r for b in warc.scan([pa.RecordBatch.from_pylist(ranges)]) for r in b.to_pylist()]
    assert [(r["page_id"], r["payload"]) for r in back] == [(i, b"x" * i) for i in range(1, 6)]


def test_round_trip_with_a_file_scheme(spark, tmp_path):
    files = warc.write(pages(spark, [(i, "u", "y" * i) for i in range(20)]), f"file://{tmp_path}/w", file_bytes=500)
    assert sorted(r["length"] for r in warc.read(spark, files).collect()) == list(range(20))


def test_archives_of_others(spark, tmp_path):
    def record(kind, block, *more):
        head = ["WARC/1.0", f"warc-type: {kind}", f"Content-Length: {len(block)}", *more]
        return warc.gzip_member("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    draw = random.Random(5)
    uri = "http://h/" + "".join(draw.choice("0123456789abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    reply = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody"
    members = [
        record("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:1>"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID:<urn:uuid:2>"),
        warc.gzip_member(b"WARC/1.1\r\nWARC-Target-URI: " + uri.encode() + b"\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(reply) + reply + b"\r\n\r\n"),
        record("revisit", b"", "WARC-Refers-To: <urn:uuid:3>", "WARC-Payload-Digest: sha1:ABC"),
        record("metadata", b"", "WARC-Record-ID: <urn:page:x>"),
    ]
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(members))
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "file string, bytes long")
    out = warc.read(spark, files, split_bytes=50).orderBy("record_type").collect()
    assert [(r["record_type"], r["page_id"], r["record_id"], r["refers_to_id"], r["digest"], r["length"]) for r in out] == [
        ("metadata", None, "<urn:page:x>", None, None, 0), ("request", None, "<urn:uuid:2>", None, None, 18),
        ("response", None, None, None, None, 4), ("revisit", None, None, "<urn:uuid:3>", "sha1:ABC", None),
        ("warcinfo", None, "<urn:uuid:1>", None, None, 13),
    ]
    assert out[2]["url"] == uri and bytes(out[2]["payload"]) == b"body" and warc.report(warc.read(spark, files)).count() == 5


def test_pages_without_an_id_revisit_one_that_has_one(spark):
    table = [(5, "u", "same " * 50), (None, "u", "same " * 50), (None, "v", "other " * 50), (None, "w", "other " * 50)]
    files = warc.write(pages(spark, table), shared_path(spark, "warc-test"))
    out = sorted(((r["record_type"], r["page_id"], r["refers_to"]) for r in warc.read(spark, files).collect()), key=repr)
    assert out == sorted([("response", 5, None), ("revisit", None, 5), ("response", None, None), ("response", None, None)], key=repr)


def test_empty_table(spark):
    files = warc.write(pages(spark, []), shared_path(spark, "warc-test"))
    assert warc.report(warc.read(spark, files)).count() == 0
    assert files.agg(F.count("*")).first()[0] == 0
