"""SimHash near-duplicates through a binary trie self-join.

Fingerprints are computed in one pass over the texts. Their distinct values
form a binary trie, one bit a level. The self-join walks pairs of trie nodes
together, adds up the bits in which they differ, and drops a pair as soon as
more than ``max_bits`` differ.

The top levels of the walk are a Spark join: a fingerprint goes to every pair
of subtrees whose prefixes differ in at most ``max_bits`` bits. The prefix
length grows with the logarithm of the number of distinct fingerprints, so a
subtree keeps about the same size. A subtree above the bound (many near
copies under one prefix) is cut into blocks, and blocks are paired like
subtrees. Below, each task walks its pair of subtrees; a subtree is a range
of a sorted array. A task returns a spanning forest of the links it found,
never all pairs of a dense group.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tessera.llm.common import stored
from tessera.llm.components import component_roots

SEED = 42


def fingerprint(text: bytes, size: int = 3) -> int:
    """The 64-bit SimHash of one text, from ``size``-word shingles with repeats."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", size: int = 3, name: str = "fp",
                     keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` and the fingerprint of ``text`` as a signed long.

    A text that is kept reaches the task once, for both.
    """
    keep = ["doc_id"] if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    if text in keep and isinstance(source.schema[text].dataType, (StringType, BinaryType)):
        at = keep.index(text)
    else:
        at = len(keep)
        source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("__text"))

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size)
                               for t in batch.column(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(prints, pa.int64())],
                                             names=[*keep, name])

    schema = source.drop("__text").withColumn(name, F.lit(0).cast("long")).schema
    return source.mapInArrow(run, schema)


def _split(prints: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where the second child of each node begins."""
    mask = np.uint64(((1 << 64) - 1) ^ ((1 << (bit + 1)) - 1))
    return np.clip(np.searchsorted(prints, (prints[low] & mask) | np.uint64(1 << bit)), low, high)


def _close(a: np.ndarray, b: np.ndarray, pairs: tuple, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare all values below small node pairs."""
    alo, ahi, blo, bhi = pairs[:4]
    wide = bhi - blo
    n = (ahi - alo) * wide
    which = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    i = alo[which] + inner // wide[which]
    j = blo[which] + inner % wide[which]
    near = np.bitwise_count(a[i] ^ b[j]) <= max_bits
    return i[near], j[near]


def trie_links(a: np.ndarray, b: np.ndarray | None, max_bits: int, leaf: int = 64, width: int = 1 << 17):
    """Yield index arrays of values of ``a`` and ``b`` that differ in at most ``max_bits`` bits.

    ``a`` and ``b`` are sorted distinct unsigned values; ``b`` is None for a
    join of ``a`` with itself. Node pairs wait on a stack in pieces of at most
    ``width``, so memory stays bounded however many pairs there are.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    one = np.ones(1, np.int64)
    stack = [(63, (0 * one, len(a) * one, 0 * one, len(b) * one, max_bits * one))]
    while stack:
        bit, pairs = stack.pop()
        alo, ahi, blo, bhi, left = pairs
        small = (ahi - alo) * (bhi - blo) <= leaf
        if bit < 0:
            small[:] = True
        if small.any():
            yield _close(a, b, tuple(x[small] for x in pairs), max_bits)
            alo, ahi, blo, bhi, left = (x[~small] for x in pairs)
        if not len(alo):
            continue
        amid, bmid = _split(a, alo, ahi, bit), _split(b, blo, bhi, bit)
        cross = left > 0
        mirrored = cross & ~((alo == blo) & (ahi == bhi)) if own else cross
        children = [(alo, amid, blo, bmid, left), (amid, ahi, bmid, bhi, left),
                    tuple(x[cross] for x in (alo, amid, bmid, bhi, left - 1)),
                    tuple(x[mirrored] for x in (amid, ahi, blo, bmid, left - 1))]
        merged = [np.concatenate(x) for x in zip(*children)]
        alive = (merged[0] < merged[1]) & (merged[2] < merged[3])
        merged = [x[alive] for x in merged]
        for at in range(0, len(merged[0]), width):
            stack.append((bit - 1, tuple(x[at:at + width] for x in merged)))


class Forest:
    """Spanning forest over a fixed number of vertices, fed with batches of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.u: list[int] = []
        self.v: list[int] = []

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        lu, lv = self.label[u], self.label[v]
        apart = np.flatnonzero(lu != lv)
        if not len(apart):
            return
        low, high = np.minimum(lu, lv)[apart], np.maximum(lu, lv)[apart]
        _, first = np.unique(low * len(self.label) + high, return_index=True)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = parent.get(p, p)
                x = p
            return x

        for k in first:
            x, y = root(int(low[k])), root(int(high[k]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.u.append(int(u[apart[k]]))
                self.v.append(int(v[apart[k]]))
        moved = np.arange(len(self.label))
        for x in list(parent):
            moved[x] = root(x)
        self.label = moved[self.label]


def _join_block(max_bits: int):
    def run(table: pa.Table) -> pa.Table:
        prints = table.column("fp").to_numpy().view(np.uint64)
        left = table.column("left").to_numpy(zero_copy_only=False)
        if (table.column("a")[0].as_py(), table.column("s")[0].as_py()) == (
                table.column("b")[0].as_py(), table.column("t")[0].as_py()):
            values = np.unique(prints)
            links = trie_links(values, None, max_bits)
            shift = 0
        else:
            a, b = np.unique(prints[left]), np.unique(prints[~left])
            values = np.concatenate([a, b])
            links = trie_links(a, b, max_bits)
            shift = len(a)
        forest = Forest(len(values))
        for i, j in links:
            forest.add(i, j + shift)
        signed = values.view(np.int64)
        return pa.table({"u": pa.array(signed[np.array(forest.u, np.int64)], pa.int64()),
                         "v": pa.array(signed[np.array(forest.v, np.int64)], pa.int64())})
    return run


def fingerprint_links(prints: DataFrame, max_bits: int = 3, subtree: int = 1 << 18, least_depth: int = 6) -> DataFrame:
    """Links ``u``, ``v`` that connect the same fingerprints as all pairs within ``max_bits`` bits do.

    ``prints`` has one long column ``fp`` of distinct non-null values.
    """
    n = prints.count()
    depth = min(60, max(least_depth, ceil(log2(max(1, n) / subtree)) if n else 0))
    masks = [sum(1 << i for i in c) for k in range(min(max_bits, depth) + 1) for c in combinations(range(depth), k)]
    node = F.shiftrightunsigned("fp", 64 - depth)
    placed = prints.select("fp", node.alias("node"))
    nodes = placed.groupBy("node").agg(F.ceil(F.count("*") / F.lit(subtree)).cast("int").alias("blocks"))
    own = placed.join(nodes, "node").select(
        "fp", "node", F.expr("cast(pmod(xxhash64(fp), blocks) as int)").alias("block"))
    spread = own.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    other = nodes.select(F.col("node").alias("other"), F.col("blocks").alias("others"))
    paired = (spread.withColumn("other", F.expr("node ^ mask")).join(other, "other")
              .withColumn("oblock", F.explode(F.expr("sequence(0, others - 1)"))))
    first = F.expr("node < other or (node = other and block <= oblock)")
    keyed = paired.select(
        "fp", first.alias("left"),
        F.when(first, F.col("node")).otherwise(F.col("other")).alias("a"),
        F.when(first, F.col("block")).otherwise(F.col("oblock")).alias("s"),
        F.when(first, F.col("other")).otherwise(F.col("node")).alias("b"),
        F.when(first, F.col("oblock")).otherwise(F.col("block")).alias("t"))
    return keyed.groupBy("a", "s", "b", "t").applyInArrow(_join_block(max_bits), "u long, v long")


def simhash_components(docs: DataFrame, size: int = 3, max_bits: int = 3, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """Near-duplicate classes of whole texts: ``doc_id``, ``fp``, ``root``, ``component_id``.

    ``fp`` is the fingerprint as a signed long, ``root`` the smallest
    fingerprint of the class, ``component_id`` the smallest doc_id in it.
    One row per input row; exact copies meet as one fingerprint before the
    join, so a group of copies of any size costs one value.

    Null and blank texts have fingerprint zero and are linked like any other.
    A text of fewer than ``size`` words is one shingle. A row with a null id
    takes part but never gives its class its name; a class of such rows only
    has a null component_id. Repeated rows each get their row. An empty table
    gives no rows. Other columns are not read.
    """
    rows = stored(with_fingerprint(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                                   size=size), "simhash-rows")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    roots = component_roots(fingerprint_links(prints.select("fp"), max_bits))
    classed = prints.join(roots, prints.fp == roots.vertex, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(classed.join(names, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate class, with all columns of ``docs``.

    The row with the smallest id stays; of several rows with that id, and of a
    class whose ids are all null, one of them.
    """
    classes = simhash_components(docs, size, max_bits, doc_id, text)
    kept = stored(classes.where("doc_id <=> component_id").select(
        F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"), F.col("root").alias("__root")).distinct(), "simhash-kept")
    own = with_fingerprint(docs, text, size, "__own", keep=docs.columns)
    joined = own.join(kept, (own["__own"] == kept["__fp"]) & own[f"`{doc_id}`"].eqNullSafe(kept["__id"]))
    return joined.dropDuplicates(["__root"]).drop("__own", "__id", "__fp", "__root")


def hex_fingerprint(column: str = "fp"):
    """A signed long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
