"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.session import scratch_path

# Bytes of text hashed at a time; bounds the size of the power tables.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Fixed value: Spark's setting that deletes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor only costs a reread of the files. With
    ``release`` the shuffle files of the write are deleted when it ends; the
    session's setting is put back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    if release:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        n = max(n, BLOCK + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every white-space separated word; words never cross rows."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    cut[0] = cut[-1] = True
    before = cut[:-1].copy()
    before[1:] |= space[:-1]
    after = cut[1:].copy()
    after[:-1] |= space[1:]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased.

    A polynomial over the word's bytes, taken from running sums, so the cost
    per byte is a few vector operations and no Python loop runs per word.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        n = int(ends[to - 1] - base)
        up, down = _tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[raw[base:base + n]].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out)


def row_slices(column: pa.Array, limit: int = BLOCK):
    """Split a text column into runs of whole rows of about ``limit`` bytes.

    Yields the first row, bytes and offsets of each run.
    """
    raw, offsets = column_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def shingle_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word windows of each row, and the index of their first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(size):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[j:j + n]
    first = np.flatnonzero(rows[:n] == rows[size - 1:size - 1 + n])
    return mix(acc[first]), first
