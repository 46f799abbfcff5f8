"""Fuzzy repeated passages by collinear chaining of shared seeds.

Seeds are ``k``-word shingles picked by minimizers: of every ``window``
consecutive shingles the one with the least hash, so two equal stretches of
``window + k - 1`` words share a seed wherever they lie. The default window
of 1 makes every shingle a seed, which edits up to the stated similarity need. Every occurrence of
a seed is joined to the seed's first occurrence (smallest doc_id, then
position) and to the preceding one, so a passage in n documents gives 2 n
matches, not n squared, and a seed that an unlike document happens to hold
first still links the documents that share the passage.

The matches of a pair of documents are chained: positions must grow in both,
and a Fenwick tree over the source positions holds the best chain end so far
under a linear gap cost. Chains are cut where the gap is too wide. The words
around each chain are then fetched from both texts and aligned by their
longest common subsequence, so ends go on past the seeds over substituted,
inserted and deleted words. The passages are the alignment's parts that are
long and alike enough, so unlike text in the same chain hides none.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.collocation import Marked, mark
from tessera.llm.common import column_bytes, row_slices, shingle_hashes, stored, word_hashes, word_spans

GAP_COST = 0.1
# Seeds that a task holds at once, ranges of hashes, and occurrences among the seeds held that make one hot.
HELD = 1 << 20
BUCKETS = 1 << 12
HOT = 32
HOT_BITS = 1 << 24  # 2 MiB, whatever the input
# Words of a stretch that are aligned at once at most; bounds the bit vectors kept.
ALIGNED = 2000


def minimizers(hashes: np.ndarray, rows: np.ndarray, window: int) -> np.ndarray:
    """Indices of the shingles that are least in some run of ``window`` shingles of their row.

    A row with fewer shingles than ``window`` is one run.
    """
    n = len(hashes)
    if not n or window == 1:
        return np.arange(n)
    least = hashes.copy()
    for j in range(1, window):
        np.minimum(least[:-j], hashes[j:], out=least[:-j])
    ends = np.r_[np.flatnonzero(rows[1:] != rows[:-1]) + 1, n]
    starts = np.r_[0, ends[:-1]]
    sizes = ends - starts
    least[np.arange(n) + window > np.repeat(ends, sizes)] = 0  # runs that would leave their row
    most = least.copy()
    for j in range(1, window):
        np.maximum(most[j:], least[:-j], out=most[j:])
    whole = np.repeat(sizes >= window, sizes)
    of_row = np.repeat(np.minimum.reduceat(hashes, starts), sizes)
    return np.flatnonzero(np.where(whole, hashes == most, hashes == of_row))


def _seed_arrays(batches, k: int, window: int):
    """Hashes, documents and positions of the minimizer seeds of batches of ``doc``, ``text``."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for at, raw, offsets in row_slices(batch.column(1)):
            starts, ends, rows = word_spans(raw, offsets)
            hashes, first = shingle_hashes(word_hashes(raw, starts, ends), rows, k)
            pick = minimizers(hashes, rows[first], window)
            row, word = rows[first[pick]], first[pick]
            before = np.searchsorted(rows, np.arange(len(offsets) - 1))  # words before each row
            yield hashes[pick], ids[at + row], (word - before[row]).astype(np.int32)


def hot_seeds(docs: DataFrame, k: int, window: int) -> bytes:
    """A bitmap of fixed size that marks every hash with ``HOT`` occurrences or more among the seeds a task holds at once."""
    def run(batches):
        def often():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values[n >= HOT].view(np.int64)), pa.array(n[n >= HOT])], names=["key", "n"])

        held, n = [], 0
        for hashes, _, _ in _seed_arrays(batches, k, window):
            held, n = [*held, hashes], n + len(hashes)
            if n >= HELD:
                yield often()
                held, n = [], 0
        if n:
            yield often()

    return mark(docs.mapInArrow(run, "key long, n long"), HOT, HOT_BITS)


_BLOCK = "bucket int, hash binary, doc binary, pos binary"


def _blocks(hashes: np.ndarray, doc: np.ndarray, pos: np.ndarray, hot: np.ndarray, at: int) -> pa.RecordBatch:
    """Seeds packed by range of their hash; hot ones in blocks of any hash from bucket ``BUCKETS + at`` on."""
    bucket = (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    bucket[hot] = BUCKETS + (at + np.arange(hot.sum()) // 1024) % BUCKETS
    order = np.argsort(bucket.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
    cuts = np.r_[first, len(order)]

    def packed(values):
        return pa.Array.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values[order]))])

    return pa.RecordBatch.from_arrays([pa.array(bucket[order[first]].astype(np.int32)), packed(hashes), packed(doc), packed(pos)],
                                      names=["bucket", "hash", "doc", "pos"])


def seed_blocks(docs: DataFrame, k: int, window: int, hot: Callable[[np.ndarray], np.ndarray], part: int = 0, parts: int = 1) -> DataFrame:
    """``bucket``, ``hash``, ``doc``, ``pos``: packed seeds of every text whose hash is ``part`` modulo ``parts``.

    A bucket is a range of hashes, so the occurrences of a seed share it;
    those of a hot seed are in buckets from ``BUCKETS`` on, dealt in turn.
    """
    def run(batches):
        at, held, n = TaskContext.get().partitionId() * 7919, [], 0

        def packed():
            hashes, doc, pos = (np.concatenate(c) for c in zip(*held))
            return _blocks(hashes, doc, pos, hot(hashes), at)

        for arrays in _seed_arrays(batches, k, window):
            mine = np.flatnonzero(arrays[0] % np.uint64(parts) == part)
            held, n = [*held, tuple(a[mine] for a in arrays)], n + len(mine)
            if n >= HELD:
                yield packed()
                at, held, n = at + HELD // 1024, [], 0
        if n:
            yield packed()

    return docs.mapInArrow(run, _BLOCK)


_FOUND = "hash long, doc long, pos int, src long, src_pos int"


def _block_links(batches):
    """Packed seeds sorted by bucket in; matches with the hash's first and the preceding one out, and hot seeds, without a source."""
    def links_of(blocks):
        hashes, doc, pos = (np.frombuffer(b"".join(c), t) for c, t in zip(zip(*blocks), (np.int64, np.int64, np.int32)))
        order = np.argsort(hashes)
        same = np.diff(hashes[order]) == 0
        order = order[np.r_[False, same] | np.r_[same, False]]  # hashes that come once have no match
        h, doc, pos = hashes[order], doc[order], pos[order]
        order = np.lexsort((pos, doc, h))
        h, doc, pos = h[order], doc[order], pos[order]
        fresh = np.r_[True, (np.diff(h) != 0) | (np.diff(doc) != 0) | (np.diff(pos) != 0)][:len(h)]
        h, doc, pos = h[fresh], doc[fresh], pos[fresh]
        same = np.r_[False, h[1:] == h[:-1]][:len(h)]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
        mine = np.flatnonzero(same)
        more = mine[mine - 1 != first[mine]]
        mine, theirs = np.r_[mine, more], np.r_[first[mine], more - 1]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (h[mine], doc[mine], pos[mine], doc[theirs], pos[theirs])],
                                          names=["hash", "doc", "pos", "src", "src_pos"])

    bucket, held, n = None, [], 0
    for batch in batches:
        for at, *block in zip(batch.column(0).to_pylist(), *(c.to_pylist() for c in batch.columns[1:])):
            if at >= BUCKETS:
                h, doc, pos = (np.frombuffer(c, t) for c, t in zip(block, (np.int64, np.int64, np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(doc), pa.array(pos), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int32())],
                    names=["hash", "doc", "pos", "src", "src_pos"])
                continue
            if at != bucket and n >= HELD // 2:
                yield links_of(held)
                held, n = [], 0
            bucket, n = at, n + len(block[2]) // 4
            held.append(block)
    if held:
        yield links_of(held)


def seed_links(docs: DataFrame, k: int, window: int, parts: int) -> DataFrame:
    """``doc``, ``pos``, ``src``, ``src_pos``: every seed of every text with the seed's first and with the preceding occurrence.

    Seeds go to the task of their range of hashes in blocks, as arrays. Hot
    ones would fill one task: those are dealt evenly, written with the matches
    and linked by ``links``. A hash that the bitmap marks by chance is linked there too.
    """
    hot = docs.sparkSession.sparkContext.broadcast(hot_seeds(docs, k, window))

    def marked(hashes):
        return Marked(hot.value)(hashes)

    found = [stored(seed_blocks(docs, k, window, marked, i, parts).repartition("bucket").sortWithinPartitions("bucket")
                    .mapInArrow(_block_links, _FOUND), "seed-links", release=True) for i in range(parts)]
    matches = [f.where("src is not null").select("doc", "pos", "src", "src_pos") for f in found]
    if any(hot.value):
        matches.append(links(reduce(DataFrame.union, [f.where("src is null").select("hash", "doc", "pos") for f in found])))
    hot.unpersist()
    return reduce(DataFrame.union, matches)


_LINK = "kind int, part int, hash long, doc long, pos int, src long, src_pos int"
_MATCH, _OPEN, _EDGE = 0, 1, 2


def _links(batches):
    """Occurrences sorted by hash, document and position in, matches with the hash's first and the preceding one out.

    The first hash of a partition may have begun in an earlier one. Its rows
    come out as ``_OPEN`` with it, with the preceding occurrence in ``src`` if that
    is in the partition. The first and last hash give an ``_EDGE`` row with
    their first and last occurrence.
    """
    part = TaskContext.get().partitionId()
    opening = held = None  # first hash of the partition; hash, first and last occurrence so far

    def rows(kind, hash_, doc, pos, src, src_pos):
        n = len(doc)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(hash_), pa.array(doc),
             pa.array(pos), src if isinstance(src, pa.Array) else pa.array(src),
             src_pos if isinstance(src_pos, pa.Array) else pa.array(src_pos)],
            names=["kind", "part", "hash", "doc", "pos", "src", "src_pos"])

    def edge(hash_, first, last):
        return rows(_EDGE, np.array([hash_]), np.array([first[0]]), np.array([first[1]], np.int32),
                    np.array([last[0]]), np.array([last[1]], np.int32))

    for batch in batches:
        h, doc, pos = (c.to_numpy() for c in batch.columns)
        if not len(h):
            continue
        n = 0
        if held is not None:  # the held hash's first and last occurrence go before the batch
            n = 2
            h = np.r_[[held[0]] * 2, h]
            doc = np.r_[held[1][0], held[2][0], doc]
            pos = np.r_[held[1][1], held[2][1], pos].astype(np.int32)
        else:
            opening = h[0]
        same = np.r_[False, h[1:] == h[:-1]]
        again = np.r_[False, same[1:] & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])]
        start = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
        at = np.flatnonzero(~again & (np.arange(len(h)) >= n))
        shut = at[same[at] & (h[at] != opening)]
        if len(shut):
            first, before = start[shut], shut - 1
            more = (doc[before] != doc[first]) | (pos[before] != pos[first])
            mine, theirs = np.r_[shut, shut[more]], np.r_[first, before[more]]
            yield rows(_MATCH, np.zeros(len(mine), np.int64), doc[mine], pos[mine], doc[theirs], pos[theirs])
        unsure = at[h[at] == opening]
        if len(unsure):
            head = ~same[unsure]
            before = np.maximum(unsure - 1, 0)
            yield rows(_OPEN, h[unsure], doc[unsure], pos[unsure], pa.array(doc[before], mask=head),
                       pa.array(pos[before], mask=head))
        begins = start[-1]
        if held is not None and held[0] == opening != h[-1]:
            last = int(np.flatnonzero(h == opening)[-1])
            yield edge(opening, held[1], (doc[last], pos[last]))
        elif held is None and opening != h[-1]:
            last = int(np.flatnonzero(h == opening)[-1])
            yield edge(opening, (doc[0], pos[0]), (doc[last], pos[last]))
        held = h[-1], (doc[begins], pos[begins]), (doc[-1], pos[-1])
    if held is not None:
        yield edge(*held)


def links(found: DataFrame) -> DataFrame:
    """``doc``, ``pos``, ``src``, ``src_pos``: every occurrence with the seed's first and with the preceding one.

    Occurrences are dealt by ranges of (hash, document, position), so those
    of a hot seed spread over many tasks; what a range lacks of its first
    hash is taken from the edges of the ranges, two rows a range at most.
    """
    by = ["hash", "doc", "pos"]
    raw = stored(found.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_links, _LINK), "seed-links", release=True)
    place, source = F.struct("doc", "pos"), F.struct("src", "src_pos")
    edges = raw.where(F.col("kind") == _EDGE).select("hash", "part", place.alias("lo"), source.alias("hi"))
    ranges = Window.partitionBy("hash").orderBy("lo")
    edges = edges.select("hash", "part", F.first("lo").over(ranges).alias("first"), F.lag("hi").over(ranges).alias("before"))
    unsure = (raw.where(F.col("kind") == _OPEN).select("hash", "part", place.alias("mine"), "src", source.alias("got"))
              .join(F.broadcast(edges), ["hash", "part"])
              .select("mine", F.array_distinct(F.array(
                  F.expr("struct(first.doc AS src, first.pos AS src_pos)"),
                  F.when(F.col("src").isNotNull(), F.col("got")).otherwise(F.col("before")))).alias("sources"), "first")
              .where("first < mine").select("mine.doc", "mine.pos", F.explode("sources").alias("s"))
              .select("doc", "pos", "s.src", "s.src_pos"))
    return raw.where(F.col("kind") == _MATCH).select("doc", "pos", "src", "src_pos").union(unsure)


class Fenwick:
    """Prefix maxima of (value, index) over ranks."""

    def __init__(self, n: int):
        self.value = [-1e300] * (n + 1)
        self.index = [-1] * (n + 1)

    def put(self, rank: int, value: float, index: int) -> None:
        i = rank + 1
        while i < len(self.value):
            if value > self.value[i]:
                self.value[i], self.index[i] = value, index
            i += i & -i

    def best(self, rank: int) -> tuple[float, int]:
        """The largest value at ranks below ``rank``."""
        value, index, i = -1e300, -1, rank
        while i > 0:
            if self.value[i] > value:
                value, index = self.value[i], self.index[i]
            i -= i & -i
        return value, index


def chains(x: np.ndarray, y: np.ndarray, weight: int) -> list[np.ndarray]:
    """Disjoint collinear chains of the matches (x, y), best first; indices in order.

    A chain scores ``weight`` a match less ``GAP_COST`` a word of distance in
    either text. Both coordinates grow strictly along a chain.
    """
    order = np.lexsort((-y, x))
    if len(order) > 1 and (np.diff(x[order]) > 0).all() and len(np.unique(y - x)) == 1:
        return [order]
    xs, ys = x[order].tolist(), y[order].tolist()
    _, ranks = np.unique(y[order], return_inverse=True)
    tree, score, back = Fenwick(int(ranks.max()) + 1), [], []
    for j, rank in enumerate(ranks.tolist()):
        value, i = tree.best(rank)
        value -= GAP_COST * (xs[j] + ys[j])
        score.append(weight + max(0.0, value))
        back.append(i if value > 0 else -1)
        tree.put(rank, score[j] + GAP_COST * (xs[j] + ys[j]), j)
    used, out = [False] * len(xs), []
    for j in sorted(range(len(xs)), key=lambda j: -score[j]):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = back[j]
        if chain:
            out.append(order[np.array(chain[::-1])])
    return out


def thinned(x: np.ndarray, y: np.ndarray, step: int, pair: np.ndarray | None = None) -> np.ndarray:
    """Indices of the matches without the inner ones of a run along a diagonal; of those every ``step``-th stays.

    Matches of several pairs are told apart by the number in ``pair``.
    """
    pair = np.zeros(len(x), np.int8) if pair is None else pair
    order = np.lexsort((x, y - x, pair))
    cx, cd, cp = x[order], (y - x)[order], pair[order]
    fresh = np.r_[True, (np.diff(cx) != 1) | (np.diff(cd) != 0) | (cp[1:] != cp[:-1])]
    starts = np.flatnonzero(fresh)
    within = np.arange(len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)]))
    return np.sort(order[(within % step == 0) | np.r_[fresh[1:], True]])


def pieces(pair: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, max_gap: int) -> np.ndarray:
    """``pair``, ``start``, ``end``, ``src_start``, ``src_end`` of the chains of distinct matches, cut at wide gaps.

    Matches come sorted by pair, ``x`` and ``y``. Most pairs have no two
    matches that are near in both texts, two matches, or all on one
    diagonal: those need no tree and are done at once.
    """
    def bounds():
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        return starts, np.diff(np.r_[starts, len(pair)])

    def any_in(flags):
        return np.logical_or.reduceat(flags, starts)

    def near(z):
        return np.r_[False, (pair[1:] == pair[:-1]) & (np.diff(z) <= max_gap)]

    out = [np.zeros((0, 5), np.int64)]
    if not len(pair):
        return out[0]
    keep = thinned(x, y, k, pair)
    pair, x, y = pair[keep], x[keep], y[keep]
    starts, sizes = bounds()
    keep = np.repeat(any_in(near(x)) & any_in(near(y[np.lexsort((y, pair))])), sizes)
    pair, x, y = pair[keep], x[keep], y[keep]
    if not len(pair):
        return out[0]
    starts, sizes = bounds()
    bent = any_in(np.r_[False, (pair[1:] == pair[:-1]) & (np.diff(y - x) != 0)])

    at = np.flatnonzero(np.repeat(~bent, sizes))
    if len(at):
        p, cx, cy = pair[at], x[at], y[at]
        first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (np.diff(cx) > max_gap)])
        last = np.r_[first[1:], len(at)] - 1
        first, last = first[last > first], last[last > first]
        out.append(np.stack([p[first], cx[first], cx[last] + k, cy[first], cy[last] + k], axis=1))

    a = starts[bent & (sizes == 2)]
    b = a + 1
    dx, dy = x[b] - x[a], y[b] - y[a]
    linked = k + GAP_COST * (x[a] + y[a]) - GAP_COST * (x[b] + y[b]) > 0  # as ``chains`` scores them
    linked &= (dx > 0) & (dy > 0) & (dx <= max_gap) & (dy <= max_gap)
    a, b = a[linked], b[linked]
    out.append(np.stack([pair[a], x[a], x[b] + k, y[a], y[b] + k], axis=1))

    for s, n in zip(starts[bent & (sizes > 2)].tolist(), sizes[bent & (sizes > 2)].tolist()):
        for chain in chains(x[s:s + n], y[s:s + n], k):
            cx, cy = x[s + chain], y[s + chain]
            cuts = np.flatnonzero((np.diff(cx) > max_gap) | (np.diff(cy) > max_gap)) + 1
            found = [(pair[s], px[0], px[-1] + k, py[0], py[-1] + k)
                     for px, py in zip(np.split(cx, cuts), np.split(cy, cuts)) if len(px) > 1]
            if found:
                out.append(np.array(found, np.int64))
    return np.concatenate(out)


def _chain_rows(k: int, max_gap: int):
    """Matches sorted by document pair in, one row a chain out."""
    def rows(table):
        columns = [c.to_numpy() for c in table.columns]
        fresh = np.r_[True, np.any([np.diff(c) != 0 for c in columns], axis=0)]
        doc, src, x, y = (c[fresh] for c in columns)
        new = np.r_[True, (np.diff(doc) != 0) | (np.diff(src) != 0)]
        starts = np.flatnonzero(new)
        long = np.repeat(np.diff(np.r_[starts, len(doc)]) > 1, np.diff(np.r_[starts, len(doc)]))
        pair = np.cumsum(new) - 1
        got = pieces(pair[long], x[long].astype(np.int64), y[long].astype(np.int64), k, max_gap)
        at = starts[got[:, 0]]
        return pa.RecordBatch.from_arrays([pa.array(doc[at]), pa.array(src[at]), *(pa.array(c.astype(np.int32)) for c in got.T[1:])],
                                          names=_KEY)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            if not len(table):
                continue
            doc, src = table.column(0).to_numpy(), table.column(1).to_numpy()
            edges = np.flatnonzero((doc != doc[-1]) | (src != src[-1]))
            at = int(edges[-1]) + 1 if len(edges) else 0
            held = table.slice(at)
            if at and len(found := rows(table.slice(0, at))):
                yield found
        if held is not None and len(found := rows(held)):
            yield found
    return run


_CHAIN = "doc long, src long, start int, end int, src_start int, src_end int"
_KEY = ["doc", "src", "start", "end", "src_start", "src_end"]


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors; equal ends are stripped first."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1]) if n else np.zeros(0, np.int64)
    tail = int(differ[0]) if len(differ) else n
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        m = row & where.get(w, 0)
        row = ((row + m) | (row - m)) & full
    return head + tail + len(a) - row.bit_count()


def _alignment(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both of a longest common subsequence, by bit vectors kept for the way back."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    where: dict[int, int] = {}
    for i, w in enumerate(a[head:].tolist()):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << (len(a) - head)) - 1
    row, rows = full, []
    for w in b[head:].tolist():
        m = row & where.get(w, 0)
        row = ((row + m) | (row - m)) & full
        rows.append(row)
    i, j, x, y = len(a), len(b), [], []
    while i > head and j > head:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            x.append(i)
            y.append(j)
        elif rows[j - 1 - head] >> (i - 1 - head) & 1:
            i -= 1
        else:
            j -= 1
    lead = np.arange(head)
    return np.r_[lead, np.array(x[::-1], np.int64)], np.r_[lead, np.array(y[::-1], np.int64)]


def _anchors(a: np.ndarray, b: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Starts of the ``k``-word shingles that come once in either stretch, as the longest run that grows in both."""
    def once(words):
        hashes, first = shingle_hashes(words.astype(np.int64).view(np.uint64), np.zeros(len(words), np.int8), k)
        values, at, n = np.unique(hashes, return_index=True, return_counts=True)
        return values[n == 1], first[at[n == 1]]

    (u, i), (v, j) = once(a), once(b)
    _, p, q = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    order = np.argsort(i[p])
    x, y = i[p][order].tolist(), j[q][order].tolist()
    tops, at, back = [], [], []
    for n, value in enumerate(y):
        k = bisect_left(tops, value)
        back.append(at[k - 1] if k else -1)
        tops[k:k + 1], at[k:k + 1] = [value], [n]
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append((x[n], y[n]))
        n = back[n]
    return out[::-1]


def alignment(a: np.ndarray, b: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words that two stretches have in common, growing in both.

    A longest common subsequence; stretches of more than ``ALIGNED`` words
    are cut at shared shingles first, or in equal parts where there are none.
    """
    cuts, at = [(0, 0)], (0, 0)
    if max(len(a), len(b)) > ALIGNED:
        for x, y in [*_anchors(a, b, k), (len(a), len(b))]:
            parts = -(-max(x - at[0], y - at[1]) // ALIGNED)
            for j in range(1, parts):
                cuts.append((at[0] + (x - at[0]) * j // parts, at[1] + (y - at[1]) * j // parts))
            if parts > 1 or max(x - cuts[-1][0], y - cuts[-1][1]) > ALIGNED // 4:
                cuts.append((x, y))
            at = x, y
    xs, ys = [], []
    for (s, t), (e, f) in zip(cuts, [*cuts[1:], (len(a), len(b))]):
        x, y = _alignment(a[s:e], b[t:f])
        xs.append(x + s)
        ys.append(y + t)
    return np.concatenate(xs), np.concatenate(ys)


def segments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Best-scoring disjoint runs of the aligned words (x, y), ends inclusive.

    An aligned word scores 2, a word left out between two of them -3: a run
    ends where the share of aligned words falls below 0.6 for good.
    """
    left_out = np.maximum(np.diff(x), np.diff(y)) - 1
    ends = np.r_[np.flatnonzero(left_out), len(x) - 1].tolist()
    runs: list[list] = []  # first, last, score before, score after
    total, first = 0, 0
    for last in ends:
        new = [first, last, total, total + 2 * (last - first + 1)]
        total = new[3] - 3 * int(left_out[last]) if last < len(x) - 1 else new[3]
        while True:
            j = len(runs) - 1
            while j >= 0 and runs[j][2] >= new[2]:
                j -= 1
            if j < 0 or runs[j][3] >= new[3]:
                break
            new = [runs[j][0], new[1], runs[j][2], new[3]]
            del runs[j:]
        runs.append(new)
        first = last + 1
    return [(r[0], r[1]) for r in runs]


def longest_alike(x: np.ndarray, y: np.ndarray, least_words: int, similarity: float) -> tuple[int, int] | None:
    """The run of the aligned words, ends inclusive, that is longest in ``x`` among those of ``least_words`` and ``similarity``."""
    if not len(x) or x[-1] - x[0] + 1 < least_words:
        return None
    n = np.arange(len(x))
    fx, fy = n - similarity * x, n - similarity * y
    slack = 1 - similarity + 1e-9
    last = np.full(len(x), len(x) - 1)
    for f in (fx, fy):
        most = np.maximum.accumulate(f[::-1])  # grows from the end
        last = np.minimum(last, len(x) - 1 - np.searchsorted(most, f - slack))
    bound = x[last] - x + 1
    best, found = least_words - 1, None
    for i in np.argsort(-bound, kind="stable").tolist():
        if bound[i] <= best:
            break
        to = last[i] + 1
        j = i + int(np.flatnonzero((fx[i:to] >= fx[i] - slack) & (fy[i:to] >= fy[i] - slack))[-1])
        if x[j] - x[i] + 1 > best:
            best, found = x[j] - x[i] + 1, (i, j)
    return found


def stretches(words: np.ndarray, other: np.ndarray, least_words: int, similarity: float
              ) -> list[tuple[int, int, int, int, float]]:
    """Parts of two stretches that are alike, with the share of the longer one's words that lie on the alignment.

    First the best-scoring runs that are long and alike enough as they are;
    then, in what lies between, the longest run that is, and so on.
    """
    x, y = alignment(words, other)

    def enough(first, last):
        n = x[last] - x[first] + 1
        return n >= least_words and last - first + 1 >= similarity * max(n, y[last] - y[first] + 1) - 1e-9

    found = [r for r in segments(x, y) if enough(*r)] if len(x) else []
    edges = [-1, *(i for r in found for i in r), len(x)]
    open_runs = list(zip(edges[::2], edges[1::2]))
    while open_runs:
        before, after = open_runs.pop()
        run = longest_alike(x[before + 1:after], y[before + 1:after], least_words, similarity)
        if run:
            i, j = before + 1 + run[0], before + 1 + run[1]
            found.append((i, j))
            open_runs += [(before, i), (j, after)]
    out = []
    for first, last in sorted(found):
        s, e, t, f = int(x[first]), int(x[last]) + 1, int(y[first]), int(y[last]) + 1
        out.append((s, e, t, f, common_words(words[s:e], other[t:f]) / max(e - s, f - t)))
    return out


def may_hold(words: np.ndarray, other: np.ndarray, least_words: int, similarity: float) -> bool:
    """Can two stretches have parts that ``stretches`` returns?

    A part that is alike enough is, in either stretch, a run in which words
    that occur in the other stretch at all have that share. Most chains of
    seeds met by chance lie in no such run and need no alignment.
    """
    for a, b, least in ((words, other, least_words), (other, words, math.ceil(similarity * least_words - 1e-9))):
        if len(a) < least:
            return False
        f = np.r_[0.0, np.cumsum(np.isin(a, b) - similarity)]
        if (f[least:] - np.minimum.accumulate(f)[:len(f) - least]).max() < -1e-6:
            return False
    return True


def may_be_alike(words: pa.ListArray, others: pa.ListArray, least_words: int, similarity: float,
                 slots: int = 1 << 12, rows: int = 256) -> np.ndarray:
    """Rows for which ``may_hold`` can be true, many at a time.

    Words are compared by their lowest bits, which takes some for equal that
    are not and so turns no row away. Long rows are not looked into.
    """
    def flat(column):
        offsets = column.offsets.to_numpy().astype(np.int64)
        return column.values.to_numpy() & (slots - 1), offsets[:-1], np.diff(offsets)

    def places(start, size):
        """Indices of the words of rows, and the row and column of each."""
        row = np.repeat(np.arange(len(size)), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        return start[row] + column, row, column

    sides = flat(words), flat(others)
    out = np.ones(len(words), bool)
    short = np.flatnonzero(np.maximum(sides[0][2], sides[1][2]) <= ALIGNED)
    short = short[np.argsort(sides[0][2][short], kind="stable")]
    for (a, a_start, a_size), (b, b_start, b_size), least in (
            (*sides, least_words), (*sides[::-1], math.ceil(similarity * least_words - 1e-9))):
        short = short[out[short]]
        out[short[a_size[short] < least]] = False
        short = short[out[short]]
        for i in range(0, len(short), rows):
            at = short[i:i + rows]
            held = np.zeros((len(at), slots), bool)
            where, row, _ = places(b_start[at], b_size[at])
            held[row, b[where]] = True
            where, row, column = places(a_start[at], a_size[at])
            f = np.full((len(at), a_size[at].max() + 1), -2.0)  # past its end a row goes down
            f[:, 0] = 0.0
            f[row, column + 1] = held[row, a[where]] - similarity
            np.cumsum(f, axis=1, out=f)
            lowest = np.minimum.accumulate(f[:, :f.shape[1] - least], axis=1)
            out[at] = (f[:, least:] - lowest).max(axis=1) >= -1e-6
    return out


def windows(doc: int, s: int, e: int, src: int, t: int, f: int, pad: int) -> list[tuple[int, int, int, int]]:
    """Word ranges to align for a chain: around ``s`` to ``e`` of a text, around ``t`` to ``f`` of its source.

    Within one text both ranges are kept apart, or the text would align with
    itself: at either end of what lies between the copies and in its middle,
    or, where a text repeats itself on and on, in the middle of it all.
    """
    if doc != src or f + pad <= s - pad:
        return [(max(0, s - pad), e + pad, max(0, t - pad), f + pad)]
    between = sorted({f, (f + s) // 2, s}) if f <= s else [(t + e) // 2]
    return [(max(0, s - pad, m), e + pad, max(0, t - pad), min(f + pad, m)) for m in between]


def _without_covered(batches):
    """Passages sorted by document and source, without those whose words all lie in passages before them."""
    doc, seen = None, np.zeros(0, bool)
    for batch in batches:
        keep = []
        for i, (d, a, b) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
            if d != doc:
                doc, seen = d, np.zeros(0, bool)
            if len(seen) < b:
                seen = np.r_[seen, np.zeros(max(b - len(seen), len(seen)), bool)]
            if not seen[a:b].all():
                keep.append(i)
                seen[a:b] = True
        if keep:
            yield batch.take(pa.array(keep))


def repeated_passages(docs: DataFrame, k: int = 5, window: int = 1, least_words: int = 50, similarity: float = 0.8,
                      max_gap: int = 25, parts: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages of ``least_words`` words or more that repeat an earlier one.

    Returns ``doc_id``, ``start``, ``end`` (word positions, end exclusive),
    ``source_id``, ``source_start``, ``source_end``, ``similarity``. Words are
    separated by white space and compared with A-Z lower-cased. Sources are
    the first and the preceding document that hold the seeds; a passage whose
    words all lie in passages of smaller sources is left out, so an exact
    passage in n documents gives n - 1 rows and its first occurrence is in
    none. A passage that a text repeats within itself counts, if the two do
    not overlap; of a stretch that repeats a phrase on and on, what comes
    after its first ``least_words`` words repeats what is before, in
    passages that may overlap one another.

    Seeds are joined in ``parts`` runs, by their hash, and chains aligned in
    as many, by their documents, one run after the other: only one run's
    shuffle files are on disk at a time.

    Rows with a null id take no part; a null or short text has no passage.
    Rows that repeat an id and its text count as one document. If one id
    comes with different texts, its passages are looked for in each, and the
    alignment uses the text whose words come last in array order. An empty
    table gives no rows. Other columns are not read.
    """
    docs = docs.where(F.col(f"`{doc_id}`").isNotNull()).select(
        F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("binary").alias("text"))
    matches = seed_links(docs, k, window, parts).select("doc", "src", "pos", "src_pos")
    linked = stored(matches.repartition("doc", "src").sortWithinPartitions("doc", "src", "pos", "src_pos")
                    .mapInArrow(_chain_rows(k, max_gap), _CHAIN).distinct(), "chains", release=True)
    pad = least_words + max_gap + window + k  # as far as a stretch may go on past the last seed of its chain

    def slices(batches):
        for batch in batches:
            # The words of each text of the batch once, then the ranges of all rows.
            texts = batch.column(0).fill_null(b"").dictionary_encode()
            words, counts = [np.zeros(0, np.int32)], []
            for _, raw, offsets in row_slices(texts.dictionary):
                starts, ends, rows = word_spans(raw, offsets)
                words.append((word_hashes(raw, starts, ends) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                counts.append(np.bincount(rows, minlength=len(offsets) - 1))
            words, which = np.concatenate(words), texts.indices.to_numpy()
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            a, b = (c.to_numpy().astype(np.int64) for c in batch.columns[1:3])
            n, base = counts[which], (np.cumsum(counts) - counts)[which]
            a = np.minimum(np.maximum(0, a - pad), n)
            sizes = np.minimum(b + pad, n) - a
            ends = np.cumsum(sizes)
            flat = words[np.arange(ends[-1] if len(ends) else 0) + np.repeat(base + a - ends + sizes, sizes)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[3:], pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat))],
                names=["own", *_KEY, "words"])

    def sides(linked):
        wanted = (linked.select(F.col("doc").alias("of"), F.lit(True).alias("own"), F.col("start").alias("a"),
                                F.col("end").alias("b"), *_KEY)
                  .union(linked.select(F.col("src").alias("of"), F.lit(False).alias("own"), F.col("src_start").alias("a"),
                                       F.col("src_end").alias("b"), *_KEY)))
        cut = docs.withColumnRenamed("doc", "of").join(wanted, "of").select("text", "a", "b", "own", *_KEY)
        return (cut.mapInArrow(slices, f"own boolean, {_CHAIN}, words array<int>").groupBy(*_KEY)
                .agg(F.max(F.when(F.col("own"), F.col("words"))).alias("words"),
                     F.max(F.when(~F.col("own"), F.col("words"))).alias("others")))

    def aligned(batches):
        for batch in batches:
            batch = batch.filter(pa.array(may_be_alike(batch.column(6), batch.column(7), least_words, similarity)))
            out = []
            for doc, src, s, e, t, f, words, others in zip(*(c.to_pylist() for c in batch.columns[:6]),
                                                           batch.column(6), batch.column(7)):
                words, others = (w.values.to_numpy() for w in (words, others))
                s0, t0 = max(0, s - pad), max(0, t - pad)
                for a0, a1, c0, c1 in windows(doc, s, e, src, t, f, pad):
                    mine, theirs = words[a0 - s0:a1 - s0], others[c0 - t0:c1 - t0]
                    if may_hold(mine, theirs, least_words, similarity):
                        out += [(doc, a + a0, b + a0, src, c + c0, d + c0, alike)
                                for a, b, c, d, alike in stretches(mine, theirs, least_words, similarity)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int32()] * 2 + [pa.float64()])],
                    names=["doc_id", "start", "end", "source_id", "source_start", "source_end", "similarity"])

    kinds = "doc_id long, start int, end int, source_id long, source_start int, source_end int, similarity double"
    by = ["doc_id", "source_id", "start", "end", "source_start"]
    part = F.pmod(F.xxhash64("doc", "src"), F.lit(parts))
    found = reduce(DataFrame.union, [stored(sides(linked.where(part == i)).mapInArrow(aligned, kinds), "alike", release=True)
                                     for i in range(parts)])
    return (found.repartition("doc_id").sortWithinPartitions(*by)
            .mapInArrow(_without_covered, kinds))


def cut_passages(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the words of their ``passages``; all columns and untouched texts stay as they are.

    The white space after a removed passage goes with it. A text of which
    nothing is left becomes empty. Rows with a null id are untouched.
    """
    spans = passages.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(F.struct("start", "end")).alias("__spans"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.join(spans, docs[f"`{doc_id}`"] == spans["__id"], "left")
    at, n = docs.columns.index(text), len(columns)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(batch.column(n).to_pylist()):
                if spans and texts[i]:
                    texts[i] = without_words(texts[i], [(x["start"], x["end"]) for x in spans])
            yield batch.select(range(n)).set_column(at, text, pa.array(texts, pa.string()))

    return joined.select(*columns, "__spans").mapInArrow(run, docs.schema)


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words in the given ranges of word numbers."""
    raw, offsets = column_bytes(pa.array([text], pa.string()))
    starts, _, _ = word_spans(raw, offsets)
    if not len(starts):
        return text
    keep = np.ones(len(raw), bool)
    bounds = np.r_[starts, len(raw)]
    for a, b in spans:
        a, b = min(a, len(starts)), min(b, len(starts))
        keep[bounds[a]:bounds[b]] = False
    return raw[keep].tobytes().decode("utf-8", "replace")
