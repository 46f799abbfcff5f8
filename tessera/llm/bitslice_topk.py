"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers. A block of rows is stored as bit slices:
for each component and each binary digit one bitmap over the rows. A query's
scores for a whole block are sums of these bitmaps, shifted by the digits of
the query's components; negative components take the complemented bitmap.
They are added by carry-save bitmap arithmetic, 64 rows a word. The top rows
are then selected from the most significant slice of the sum downward. Rows
that tie at the boundary are told apart exactly, by their ids.

The index is built where the rows are read, without a shuffle, and written.
Blocks of queries are then paired with blocks of rows; only each pair's best
rows are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

# Components below are handled as 64-bit integers, wider ones as Python integers.
NARROW = float(1 << 31)
LONG = 1 << 63
_ONES = np.uint64((1 << 64) - 1)


class Block:
    """Bit slices of one block of integer vectors, rows in order of id."""

    def __init__(self, ids: np.ndarray, planes: np.ndarray, low: np.ndarray, width: np.ndarray):
        self.ids, self.planes, self.low, self.width = ids, planes, low, width
        self.first = np.cumsum(width) - width
        self.all = _bitmap(np.ones(len(ids), bool))

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> Block:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(axis=0)
        shifted = values - low
        width = np.array([int(x).bit_length() for x in shifted.max(axis=0)], np.int64)
        planes = [_bitmap((shifted[:, j] >> b) & 1 != 0)
                  for j in range(len(low)) for b in range(width[j])]
        words = (len(ids) + 63) // 64
        return cls(ids, np.array(planes, np.uint64).reshape(len(planes), words), low, width)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the block's scores, least significant first, and the constant to add to them."""
        used = np.flatnonzero((query != 0) & (self.width > 0))
        size = np.abs(query)
        plane = np.concatenate([np.arange(self.first[j], self.first[j] + self.width[j]) for j in used] or [[]]).astype(np.int64)
        owner = np.repeat(used, self.width[used])
        weight = plane - self.first[owner]
        digits = int(size.max(initial=0)).bit_length()
        due: dict[int, list[np.ndarray]] = {}
        for c in range(digits):
            on = (size[owner] >> c) & 1 != 0
            for w in np.unique(weight[on]):
                pick = on & (weight == w)
                due.setdefault(int(w) + c, []).append(
                    self.planes[plane[pick]] ^ np.where(query[owner[pick]] < 0, _ONES, np.uint64(0))[:, None])
        slices, at = [], 0
        while any(k >= at for k in due):
            terms = due.pop(at, [])
            m = np.concatenate(terms) if terms else np.zeros((1, self.planes.shape[1]), np.uint64)
            carries = due.setdefault(at + 1, []) if len(m) > 1 else []
            while len(m) > 2:
                n = len(m) // 3
                a, b, c = m[:n], m[n:2 * n], m[2 * n:3 * n]
                x = a ^ b
                carries.append((a & b) | (x & c))
                m = np.concatenate([x ^ c, m[3 * n:]])
            if len(m) == 2:
                carries.append((m[0] & m[1])[None])
                m = (m[0] ^ m[1])[None]
            slices.append(m[0])
            at += 1
        base = sum(q * l + (q * ((1 << w) - 1) if q < 0 else 0)
                   for q, l, w in zip(query.tolist(), self.low.tolist(), self.width.tolist()))
        return slices, base

    def above(self, slices: list[np.ndarray], bound: int) -> np.ndarray:
        """Rows whose slices make a larger number than ``bound``."""
        if bound < 0:
            return self.all
        more, same = np.zeros_like(self.all), self.all
        for w in range(max(len(slices), bound.bit_length()) - 1, -1, -1):
            s = slices[w] if w < len(slices) else np.zeros_like(self.all)
            if bound >> w & 1:
                same = same & s
            else:
                more, same = more | (same & s), same & ~s
        return more

    def top(self, query_id: int | None, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows whose id is not ``query_id`` and whose score fits a long."""
        slices, base = self.scores(query)
        open_rows = self.all
        if base + (1 << len(slices)) > LONG:
            open_rows = open_rows & ~self.above(slices, LONG - 1 - base)
        if base < -LONG:
            open_rows = open_rows & self.above(slices, -LONG - 1 - base)
        if query_id is not None:
            lo, hi = np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right")
            if lo < hi:
                own = np.zeros(len(self.ids), bool)
                own[lo:hi] = True
                open_rows = open_rows & ~_bitmap(own)
        sure = np.zeros_like(open_rows)
        for s in reversed(slices):
            with_bit = open_rows & s
            n = int(np.bitwise_count(sure | with_bit).sum())
            if n > k:
                open_rows = with_bit
            else:
                sure = sure | with_bit
                open_rows = open_rows & ~s
                if n == k:
                    open_rows = np.zeros_like(sure)
                    break
        rows = _rows(sure)
        rows = np.concatenate([rows, _rows(open_rows, k - len(rows))])
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        score = [base] * len(rows)
        for w, s in enumerate(slices):
            for i in np.flatnonzero((s[word] >> bit) & np.uint64(1)).tolist():
                score[i] += 1 << w
        return self.ids[rows], np.array(score, np.int64)


def _bitmap(flags: np.ndarray) -> np.ndarray:
    bits = np.zeros((len(flags) + 63) // 64 * 64, np.uint8)
    bits[:len(flags)] = flags
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _rows(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    """Numbers of the set rows, the first ``most`` of them."""
    words = np.flatnonzero(bitmap)
    if most is not None:
        words = words[:max(0, most)]
    bits = np.unpackbits(bitmap[words].view(np.uint8), bitorder="little").reshape(-1, 64)
    i, j = np.nonzero(bits)
    rows = words[i] * 64 + j
    return rows if most is None else rows[:max(0, most)]


def usable(column):
    """Is the vector there, with every component there and finite?"""
    return column.isNotNull() & F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))


def _quantised(column: pa.Array) -> list[np.ndarray]:
    """``floor(256 * x)`` of each vector: 64-bit integers, or Python integers if a component is wide."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    narrow = np.abs(flat) < NARROW / 256
    values = np.floor(np.where(narrow, flat, 0.0) * 256.0).astype(np.int64)
    out = np.split(values, ends[:-1]) if len(ends) else []
    if not narrow.all():
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(~narrow), "right")).tolist():
            vector = flat[ends[i] - len(out[i]):ends[i]].tolist()
            out[i] = np.array([math.floor(x * 256.0) if abs(x) < 1 << 53 else int(x) * 256 for x in vector], object)
    return out


_INDEX = "block long, n int, ids binary, planes binary, low binary, width binary"


def build_index(vectors: DataFrame, block_rows: int = 1 << 16) -> DataFrame:
    """Bit-sliced blocks of the rows of ``vec_id``, ``embedding``; vectors of one length share a block, wide ones have their own."""
    def run(batches):
        part, number, held = TaskContext.get().partitionId(), 0, {}

        def emit(rows):
            nonlocal number
            block = Block.build(np.array([r[0] for r in rows], np.int64), np.stack([r[1] for r in rows]))
            number += 1
            return pa.RecordBatch.from_pydict({
                "block": [(part << 24) + number], "n": pa.array([len(rows)], pa.int32()),
                "ids": [block.ids.tobytes()], "planes": [block.planes.tobytes()],
                "low": [",".join(map(str, block.low.tolist())).encode()], "width": [block.width.tobytes()]})

        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), _quantised(batch.column(1))):
                kind = len(vector), vector.dtype == object
                rows = held.setdefault(kind, [])
                rows.append((vec_id, vector))
                if len(rows) == block_rows:
                    yield emit(held.pop(kind))
        for rows in held.values():
            yield emit(rows)

    return stored(vectors.mapInArrow(run, _INDEX), "bitslice-index")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
          block_rows: int = 1 << 16, query_rows: int = 256) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each row of ``queries``.

    Components become ``floor(256 * x)``; scores are exact integers. Returns
    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the
    smaller vec_id. Rows with the query's own id are not candidates.

    Rows with a null id, a null vector, or a null or non-finite component take
    no part. A query meets the vectors of its own length; empty vectors score
    0 with each other. A pair whose score does not fit a long takes no part. Repeated query rows count once; repeated
    candidate rows each count. If fewer than ``k`` candidates exist, all are
    returned; an empty table gives no rows. Other columns are not read.
    """
    def part(df):
        column = F.col(f"`{embedding}`")
        return df.where(F.col(f"`{vec_id}`").isNotNull() & usable(column)).select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"), column.alias("embedding"))

    index = build_index(part(vectors), block_rows)
    blocks = max(1, index.count())
    asked = part(queries).distinct()
    chunks = max(1, -(-asked.count() // query_rows))
    asked = (asked.withColumn("chunk", F.expr(f"cast(pmod(xxhash64(vec_id, embedding), {chunks}) as int)"))
             .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .groupBy("chunk", "slot").agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("asked")))
    placed = (index.withColumn("slot", F.expr(f"cast(pmod(xxhash64(block), {blocks}) as int)"))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    tasks = min(blocks * chunks, 100_000)
    pairs = (placed.repartition(tasks, "chunk", "slot").join(asked.repartition(tasks, "chunk", "slot"), ["chunk", "slot"])
             .select("n", "ids", "planes", "low", "width", "asked"))

    def run(batches):
        for batch in batches:
            for n, ids, planes, low, width, rows in zip(*batch.columns):
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                words = (n.as_py() + 63) // 64
                width = np.frombuffer(width.as_buffer(), np.int64)
                low = np.array([int(x) for x in low.as_py().decode().split(",") if x], object)
                planes = np.frombuffer(planes.as_buffer(), np.uint64).reshape(int(width.sum()), words)
                block = Block(ids, planes, low, width)
                asked = rows.values
                found = [(q, *block.top(q, v, k)) for q, v in zip(
                    asked.field("vec_id").to_pylist(), _quantised(asked.field("embedding"))) if len(v) == len(low)]
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([q for q, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64)),
                        pa.array(np.concatenate([i for _, i, _ in found])),
                        pa.array(np.concatenate([s for _, _, s in found]))], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
