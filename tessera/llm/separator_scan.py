"""Token counts from flat token files by a separator scan.

A token file is a plain array of unsigned integers: documents one after the
other, each followed by the end-of-document identifier, with no index. The
scan cuts files into blocks of bytes. A task finds the separators of a block
by one vectorised comparison. Boundaries are stitched across blocks by prefix
scans over one small row a block: how many documents ended before the block,
and where the document open at its start began. A document may span any
number of blocks.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.llm.warc import open_fs

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256  # fixed value: the vocabulary's identifier for the end of a document
# Fixed value: how this vocabulary splits text into pieces.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SUPER = 1024  # blocks that are scanned together in the first level of the prefix scan


def encoding(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int = END, width: int = 2,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise ``docs`` into flat files under ``folder``, one a task.

    Returns ``path``, ``bytes``, ``number`` (of the document in its file) and
    ``doc_id``, one row a document; Spark commits it, so it names only files
    of attempts that count. A null text is an empty document. ``width`` is
    the bytes of a token, 2 or 4.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = np.dtype(f"<u{width}")

    def run(batches):
        encode, out, name, size, ids = encoding(vocabulary).encode_ordinary, None, "", 0, []
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                if out is None:
                    fs, base = open_fs(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.tokens"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                flat: list[int] = []
                for t in part.column(1).to_pylist():
                    if t:
                        flat += encode(t)
                    flat.append(end)
                data = np.array(flat, kind).tobytes()
                out.write(data)
                size += len(data)
                ids += part.column(0).to_pylist()
        if out is not None:
            out.close()
            path = f"{folder.rstrip('/')}/{name}"
            for at in range(0, len(ids), 50_000):
                some = ids[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(some)), pa.array([size] * len(some), pa.int64()),
                     pa.array(range(at, at + len(some)), pa.int64()), pa.array(some, pa.int64())],
                    names=["path", "bytes", "number", "doc_id"])

    return stored(rows.mapInArrow(run, "path string, bytes long, number long, doc_id long"), "token-files")


def _blocks(files: DataFrame, block_bytes: int, end: int, width: int) -> DataFrame:
    """One row a block: its tokens and the positions of its separators in the file, in tokens."""
    block_bytes = max(width, block_bytes // width * width)
    ranges = files.where("bytes > 0").select("path", "bytes", F.posexplode(
        F.expr(f"sequence(0L, bytes - 1, {block_bytes}L)")).alias("block", "start"))
    tasks = max(1, ranges.count())

    def run(batches):
        for batch in batches:
            for path, size, block, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as file:
                    data = file.read_at(min(block_bytes, size - start), start)
                tokens = np.frombuffer(data, f"<u{width}", len(data) // width)
                found = np.flatnonzero(tokens == end).astype(np.int64) + start // width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int32()), pa.array([start // width + len(tokens)], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))],
                    names=["path", "block", "stop", "found"])

    return ranges.repartition(min(tasks, 100_000)).mapInArrow(run, "path string, block int, stop long, found array<long>")


def scan_documents(files: DataFrame, block_bytes: int = 16 << 20, end: int = END, width: int = 2) -> DataFrame:
    """Documents of flat token files named by ``path`` and ``bytes``.

    Returns ``path``, ``number`` (from 0 in each file), ``start`` (in tokens),
    ``tokens`` (without the separator) and ``closed``; tokens after the last
    separator are an open document. Two separators in a row hold an empty
    document. Odd bytes at the end of a file, fewer than a token has, are
    ignored. Empty files and tables give no rows.
    """
    blocks = stored(_blocks(files.select("path", "bytes").distinct(), block_bytes, end, width), "separator-blocks")
    totals = blocks.select("path", "block", F.expr(f"block div {SUPER}").alias("super"), "stop",
                           F.size("found").alias("n"), F.array_max("found").alias("last"))
    inside = Window.partitionBy("path", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("path").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = (totals.groupBy("path", "super").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
              .select("path", "super", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("n_before"),
                      F.max("last").over(across).alias("last_before")))
    scanned = (totals.select("path", "super", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("n_in"),
                             F.max("last").over(inside).alias("last_in"))
               .join(supers, ["path", "super"])
               .select("path", "block", (F.col("n_in") + F.col("n_before")).alias("number"),
                       (F.coalesce("last_in", "last_before", F.lit(-1)) + 1).alias("begin")))
    closed = (blocks.join(scanned, ["path", "block"])
              .select("path", "number", "found", F.expr(
                  "transform(found, (x, i) -> if(i = 0, begin, found[i - 1] + 1))").alias("starts"))
              .select("path", "number", F.posexplode(F.arrays_zip("starts", "found")).alias("i", "d"))
              .select("path", (F.col("number") + F.col("i")).alias("number"), F.col("d.starts").alias("start"),
                      (F.col("d.found") - F.col("d.starts")).alias("tokens"), F.lit(True).alias("closed")))
    rest = (totals.groupBy("path").agg(F.sum("n").alias("number"), F.max("stop").alias("stop"),
                                       F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"))
            .where("stop > start").select("path", "number", "start", (F.col("stop") - F.col("start")).alias("tokens"),
                                          F.lit(False).alias("closed")))
    return closed.unionByName(rest)


def document_tokens(docs: DataFrame, folder: str, block_bytes: int = 16 << 20, **how) -> DataFrame:
    """``doc_id`` and ``tokens`` of every row of ``docs``, by writing token files and scanning them.

    Repeated rows each have a row; a null id stays null; a null or empty text
    has no tokens; an empty table gives no rows. Other columns are not read.
    """
    written = write_tokens(docs, folder, **how)
    found = scan_documents(written.select("path", "bytes"), block_bytes, how.get("end", END), how.get("width", 2))
    return written.select("path", "number", "doc_id").join(found.select("path", "number", "tokens"), ["path", "number"]).select(
        "doc_id", "tokens")
