import base64
import gzip
import hashlib
import io
import random

import pytest

from tessera.llm import warc as W
from tessera.session import scratch_path

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2\r\nX: y", "same"), (5, None, "same"), (5, None, "same"), (3, "http://a/3", None),
         (4, "http://a/4", ""), (6, "http://a/6", "é" * 50_000), (None, "http://a/n", "same"), (None, None, "lonely"),
         (7, "u", "WARC/1.1\r\n\r\n\x1f"), (8, "u", "x" * 3_000_000)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows],
                                 "page_id long, url string, html string, payload string, bytes int")


def read(spark, files, split):
    return W.read_archives(files, split_bytes=split).collect()


@pytest.fixture(scope="module")
def files(spark):
    return W.write_archives(table(spark, PAGES).repartition(3), scratch_path(spark, "warc-test"), roll_bytes=2000)


def test_round_trip_at_any_split(spark, files):
    rows = read(spark, files, 1 << 20)
    assert len(rows) == len(PAGES) and len({r.path for r in rows}) > 1
    by = {}
    for r in rows:
        by.setdefault(r.record_id, []).append(r)
    for page, url, html in PAGES:
        full = (html or "").encode()
        for r in by[f"<urn:page:{'null' if page is None else page}>"]:
            if page is not None:
                assert r.payload_digest == base64.b32encode(hashlib.sha1(full).digest()).decode()
                assert r.payload_bytes == len(full) and (r.payload is None) == (r.record_type == "revisit")
                assert r.payload is None or bytes(r.payload) == full
    kinds = {k: sorted((r.record_type, r.refers_to) for r in v) for k, v in by.items()}
    assert kinds["<urn:page:5>"] == [("response", None)] * 2
    assert kinds["<urn:page:1>"] == kinds["<urn:page:2>"] == [("revisit", "<urn:page:5>")]
    assert kinds["<urn:page:3>"] == [("revisit", "<urn:page:4>")] and kinds["<urn:page:4>"] == [("response", None)]
    assert kinds["<urn:page:null>"] == [("response", None), ("revisit", "<urn:page:5>")]
    small = [sorted(map(str, read(spark, files, s))) for s in (700, 10_000)]
    assert small[0] == small[1] == sorted(map(str, rows))


def test_files_are_plain_gzip_members(files):
    for f in files.collect():
        fs, name = W.open_fs(f.path)
        with fs.open_input_file(name) as file:
            data = file.read()
        assert len(data) == f.bytes
        assert gzip.GzipFile(fileobj=io.BytesIO(data)).read().count(b"WARC/1.1\r\nWARC-Type") == f.records


def test_false_magic_and_damage(tmp_path):
    def rec(i, payload):
        return W.member(W.record(i, None, payload, None, "1970-01-01T00:00:00Z"), 6)

    inner = rec(9, b"inner")
    stored_block = W.member(W.record(1, None, W.MAGIC * 50, None, "d"), 0)  # magic bytes in the clear
    broken = bytearray(rec(2, bytes(range(256)) * 40))
    broken[-6] ^= 0xFF  # checksum
    data = W.MAGIC + b"junk" + stored_block + bytes(broken) + W.member(b"not a record", 6) + rec(3, b"last")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    fs, name = W.open_fs(str(path))
    for split in (len(data), 37):
        with fs.open_input_file(name) as file:
            got = [x for s in range(0, len(data), split) for x in W.scan(file, s, min(len(data), s + split))]
        kinds = [(None if d is None else W.headers(d.partition(b"\r\n\r\n")[0])["warc-record-id"]) for _, d in got]
        assert kinds == ["<urn:page:1>", None, "<urn:page:3>"]
    assert inner[:3] == W.MAGIC


def test_least_bytes_and_empty(spark):
    pages = table(spark, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")])
    got = {r.record_id: r.record_type for r in read(spark, W.write_archives(pages, scratch_path(spark, "w"), least_bytes=3), 1 << 20)}
    assert got == {"<urn:page:1>": "response", "<urn:page:2>": "response", "<urn:page:3>": "revisit", "<urn:page:4>": "response"}
    none = W.write_archives(pages.limit(0), scratch_path(spark, "w"))
    assert none.count() == 0 and read(spark, none, 1 << 20) == []


def test_very_long_urls_are_read_at_any_split(spark):
    rng = random.Random(1)
    pages = [(1, "data:," + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=400_000)), "first"), (2, "\x01" * 100_000, "second"),
             (3, "http://a/" + "x" * 70_000, "second"), (4, "http://a/4", "last")]
    files = W.write_archives(table(spark, pages).coalesce(1), scratch_path(spark, "warc-urls"))
    for split in (1 << 14, 1 << 26):
        rows = {r.record_id: r for r in read(spark, files, split)}
        assert len(rows) == 4 and all(r.record_type in ("response", "revisit") for r in rows.values())
        assert rows["<urn:page:1>"].target_uri == pages[0][1] and rows["<urn:page:2>"].target_uri == "%01" * 100_000
