"""WARC archives: a writer with revisit records and a splittable reader.

The writer puts one gzip member per record. A payload that several pages
share is stored once, as the response of the page with the largest id; the
other pages get revisit records that refer to it.

The reader cuts every file into byte ranges. The task of a range looks for
gzip magic, checks each candidate member by decoding it as far as the WARC
header, and owns the records that start inside its range, reading past the
end of the range for the last one. No index is needed, so a file of any size
is read by many tasks.

Files are opened through ``pyarrow.fs``, by the URI of the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

MAGIC = b"\x1f\x8b\x08"
_AHEAD = 1 << 16
_STEP = 1 << 18
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a plain absolute path is local."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record, uncompressed."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        safe = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
        head.insert(4, f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head[-1:-1] = [f"WARC-Refers-To: <urn:page:{refers_to}>",
                       "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    out = zlib.compressobj(level, zlib.DEFLATED, 31)
    return out.compress(data) + out.flush()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url",
                   html: str = "html", date: str = "1970-01-01T00:00:00Z", level: int = 6,
                   roll_bytes: int = 1 << 30) -> DataFrame:
    """Write ``pages`` as ``.warc.gz`` files under ``folder``; return ``path``, ``bytes``, ``records``.

    Pages whose payloads are equal and of at least ``least_bytes`` bytes share
    one response, that of the largest page_id. A task starts a new file once
    ``roll_bytes`` are written. Every attempt of a task writes files of its
    own; the returned table, which Spark commits, names only those of the
    attempts that count, so a lost executor leaves no half file in use.

    A null html is an empty payload. A null url leaves out the target URI. A
    null page_id is smaller than any other; if a group has only such pages,
    all are responses. Rows that repeat the largest page_id of a group are
    all responses. An empty table gives no files. Other columns are not read.
    """
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b"")).alias("payload"))
    keyed = rows.withColumn("key", F.when(F.length("payload") >= least_bytes, F.sha1("payload")))
    shared = (keyed.where("key is not null").groupBy("key")
              .agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"))
    plan = keyed.join(shared, "key", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("kept")), F.col("kept")).alias("refers_to"))

    def run(batches):
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        out, path, size, n, done = None, "", 0, 0, []
        for batch in batches:
            for page, link, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, size, n = f"{base}/part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                data = member(record(page, link, payload, refers, date), level)
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((path, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, n))
        if done:
            names, sizes, counts = zip(*done)
            uris = [f"{folder.rstrip('/')}/{x.rsplit('/', 1)[1]}" for x in names]
            yield pa.RecordBatch.from_pydict({"path": uris, "bytes": sizes, "records": counts})

    return stored(plan.mapInArrow(run, "path string, bytes long, records long"), "warc-files")


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines) if sep}


class _Bytes:
    """Random reads of a file, through one buffer that starts with the task's range."""

    def __init__(self, file, start: int, n: int):
        self.file, self.start, self.data = file, start, file.read_at(n, start)

    def get(self, at: int, n: int) -> bytes:
        i = at - self.start
        if 0 <= i and i + n <= len(self.data):
            return self.data[i:i + n]
        return self.file.read_at(n, at)


def _is_member(source: _Bytes, at: int) -> bool:
    """Does a gzip member with a WARC header start here?"""
    inflate = zlib.decompressobj(31)
    out, seen, step, found = bytearray(), 0, 256, -1
    try:
        while found < 0 and not inflate.eof:
            chunk = inflate.unconsumed_tail
            if not chunk:
                chunk = source.get(at + seen, max(step, 4096))
                seen += len(chunk)
            if not chunk:
                return False
            searched = max(0, len(out) - 3)
            out += inflate.decompress(chunk, step)
            if out[:7] != b"WARC/1."[:len(out[:7])]:
                return False
            found, step = out.find(b"\r\n\r\n", searched), min(2 * step, _STEP)
    except zlib.error:
        return False
    return found >= 0 and {"warc-type", "content-length"} <= headers(bytes(out[:found])).keys()


def _member(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The whole member at this offset and where it ends; None if it is damaged."""
    inflate = zlib.decompressobj(31)
    parts, seen, step = [], at, 1 << 13
    try:
        while not inflate.eof:
            chunk = source.get(seen, step)
            if not chunk:
                return None
            seen, step = seen + len(chunk), min(2 * step, _STEP)
            parts.append(inflate.decompress(chunk))
    except zlib.error:
        return None
    return b"".join(parts), seen - len(inflate.unused_data)


def _find(source: _Bytes, at: int, end: int) -> int | None:
    """The first member that starts in ``[at, end)``."""
    while at < end:
        chunk = source.get(at, min(_STEP, end - at) + len(MAGIC) - 1)
        i = chunk.find(MAGIC)
        while i >= 0:
            if at + i < end and _is_member(source, at + i):
                return at + i
            i = chunk.find(MAGIC, i + 1)
        at += min(_STEP, end - at)
    return None


def scan(file, start: int, end: int):
    """Offsets and bytes of the records that start in ``[start, end)``; None for a damaged one."""
    source, at = _Bytes(file, start, min(end - start + _AHEAD, 1 << 27)), start
    while (at := _find(source, at, end)) is not None:
        while at < end and _is_member(source, at):
            got = _member(source, at)
            if got is None:
                yield at, None
                at += 1
                break
            yield at, got[0]
            at = got[1]


_FIELDS = {"path": pa.string(), "offset": pa.int64(), "record_type": pa.string(), "record_id": pa.string(),
           "target_uri": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(),
           "payload_bytes": pa.int64(), "payload": pa.binary()}


def _row(path: str, offset: int, data: bytes | None, with_payload: bool) -> tuple:
    if data is None:
        return path, offset, "damaged", None, None, None, None, None, None
    head, _, rest = data.partition(b"\r\n\r\n")
    h = headers(head)
    block = rest[:int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    common = (path, offset, h["warc-type"], h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"))
    if h["warc-type"] == "revisit":
        n = headers(http).get("content-length")
        return *common, h.get("warc-payload-digest", "").removeprefix("sha1:"), None if n is None else int(n), None
    if not h.get("content-type", "").startswith("application/http"):
        payload = block
    return *common, digest(payload), len(payload), payload if with_payload else None


def read_archives(files: DataFrame, split_bytes: int = 64 << 20, with_payload: bool = True) -> DataFrame:
    """Read the records of the ``.warc.gz`` files named by ``path`` and ``bytes``.

    One row per record: file, offset, type, ids, digest and length of the
    payload, and the payload itself (null for revisits, or for all records if
    ``with_payload`` is false). The digest of a stored payload is computed
    from the bytes read. A member whose header is sound but whose data are
    not gives a row of type ``damaged``, and the scan goes on after it.
    """
    splits = files.where("bytes > 0").select("path", "bytes", F.explode(
        F.expr(f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("start"))
    tasks = max(1, splits.count())

    def run(batches):
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as file:
                    rows, held = [], 0
                    for offset, data in scan(file, start, min(size, start + split_bytes)):
                        rows.append(_row(path, offset, data, with_payload))
                        held += len(data or b"") if with_payload else 0
                        if held > 8 << 20 or len(rows) >= 10_000:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    schema = ", ".join(f"{k} {'long' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}"
                       for k, t in _FIELDS.items())
    return splits.repartition(tasks).mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FIELDS.values())],
                                      names=list(_FIELDS))


def page_of(column: str):
    """The page id in a record id that the writer made."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
