"""Prefix trie of conversations by vertical bitmaps.

A conversation is a sequence of turns; a node of the trie is a distinct
sequence of first turns, its members the conversations that begin with it.

Conversations are cut into segments of 64 turns and dealt by ranges
of (segment, sequence before it, first turn, conversation), so that what shares
a prefix mostly meets in one shard, and neither a long conversation nor a
popular prefix is one task's load. A shard holds at most 4,096 conversations.
It indexes each (position, turn) to the bitset of the conversations that
have it. Depth-first, the bitset of a node is intersected with the postings
of the next position: each hit is a child, its popcount the number of members, its
part that ends there the end list. Shards' nodes are then summed by the
node's key.

What depends on a node's whole subtree needs no walk over shards. Every node has an
owner, its smallest member. A conversation owns the nodes of its path from
some depth on, as nobody smaller can join later. Of each member, the
words between a node and the first node that the member owns are the words it
shares there; these, summed over members, are what the subtree saves. The leaves
below a node are its members that own a leaf. So a second walk, with every
conversation's first owned depth known, sums both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import stored
from tessera.operators.joins import checked_broadcast
from tessera.operators.sequence import number_and_neighbours

SEGMENT = 64  # turns of a conversation in one shard
SHARD = 4096  # conversations of a shard: the bits of its bitsets
HOT = 10_000  # children above which a parent's row is sent to its children
KEY = ["depth", "k1", "k2"]


def turn_rows(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """``conv``, ``pos`` (from 1), ``turn_hash`` and ``words`` of every turn.

    Ordered by ``turn``, null first, and where that is equal by the hash of role
    and text. A null role or text is empty. The text goes no further than this.
    """
    if not isinstance(conversations.schema[conv_id].dataType, T.IntegralType):
        raise TypeError(f"{conv_id} must be an integer column")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn_hash"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    return (number_and_neighbours(rows, ["conv"], ["turn", "turn_hash"], "words", seq="pos")
            .select("conv", F.col("pos").cast("long").alias("pos"), "turn_hash", "words"))


def crossed(turns: DataFrame, group: int = 20, kinds: int = 4, chunk: int = 1 << 20) -> DataFrame:
    """Conversations that begin with turns of their group's first one.

    With h = crc32(decimal conv) % ``kinds`` and b = conv - conv % ``group``:
    the first h turns of b, as many as it has, then conv's own turns after its
    first h. Returns ``conv``, ``pos``, ``turn_hash``, ``words`` and
    ``length``; a conversation left without turns has one row with ``pos`` 0.
    """
    h = F.expr(f"crc32(cast(conv as string)) % {kinds}")
    heads = (turns.where(F.col("pos") < kinds).groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "turn_hash", "words"))).alias("head")))
    convs = turns.groupBy("conv").agg(F.max("pos").alias("own")).withColumn("h", h).withColumn("base", F.expr(f"conv - conv % {group}"))
    convs = (convs.join(heads, "base", "left")
             .withColumn("head", F.expr("slice(coalesce(head, array()), 1, cast(h as int))")).drop("base")
             .withColumn("lent", F.size("head").cast("long")).withColumn("length", F.expr("lent + greatest(own - h, 0L)")))
    convs = stored(convs, "trie-conversations")
    lent = convs.where("length > 0 and lent > 0").select("conv", F.explode("head").alias("t"), "length").select(
        "conv", "t.pos", "t.turn_hash", "t.words", "length")
    # A long conversation's turns meet its row chunk by chunk.
    rows = turns.select("*", F.expr(f"pos div {chunk}").alias("chunk"))
    by_chunk = convs.where("own > h").select("conv", "h", "lent", "length", F.explode(F.expr(f"sequence(0L, own div {chunk})")).alias("chunk"))
    rest = rows.join(by_chunk, ["conv", "chunk"]).where("pos > h").select(
        "conv", F.expr("pos - h + lent").alias("pos"), "turn_hash", "words", "length")
    empty = convs.where("length = 0").select("conv", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_hash"),
                                             F.lit(0).alias("words"), "length")
    return lent.unionByName(rest).unionByName(empty)


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation and ``segment`` turns, with the key of the sequence before it.

    A turn's key is 128 bits of its position and hash, a sequence's the
    exclusive or of its turns' keys.
    """
    keyed = turns.select("conv", F.expr(f"greatest(pos - 1, 0L) div {segment}").alias("seg"), "length", F.when(
        F.col("pos") > 0, F.struct("pos", F.xxhash64("pos", "turn_hash").alias("k1"),
                                   F.xxhash64("turn_hash", F.lit("second"), "pos").alias("k2"), "words")).alias("t"))
    cut = keyed.groupBy("conv", "seg").agg(
        F.max("length").alias("length"), F.sort_array(F.collect_list("t")).alias("turns"),
        F.expr("bit_xor(t.k1)").alias("x1"), F.expr("bit_xor(t.k2)").alias("x2"))
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    return stored(cut.select("conv", "seg", "length", "turns", *[
        F.coalesce(F.expr(f"bit_xor(x{i})").over(before), F.lit(0).cast("long")).alias(f"b{i}") for i in (1, 2)]), "trie-segments")


class Shard:
    """Bitsets over the conversations of a block of segments; bit i is the i-th smallest conversation."""

    def __init__(self, rows: list[dict], segment: int):
        self.rows = rows = sorted(rows, key=lambda r: r["conv"])
        self.seg, self.first = rows[0]["seg"], segment * rows[0]["seg"]
        self.convs = [r["conv"] for r in rows]
        self.turns = [[(t["k1"], t["k2"]) for t in r["turns"]] for r in rows]
        self.words = [[t["words"] for t in r["turns"]] for r in rows]
        width = max(map(len, self.turns))
        self.postings: list[dict[tuple[int, int], int]] = [{} for _ in range(width)]
        self.here, self.ends = [0] * (width + 1), [0] * (width + 1)
        self.bases: dict[tuple[int, int], int] = {}
        for i, (row, turns) in enumerate(zip(rows, self.turns)):
            bit = 1 << i
            for j, t in enumerate(turns):
                self.postings[j][t] = self.postings[j].get(t, 0) | bit
                self.here[j] |= bit
            if row["length"] == self.first + len(turns):
                self.ends[len(turns)] |= bit
            base = (row["b1"], row["b2"])
            self.bases[base] = self.bases.get(base, 0) | bit

    def walk(self) -> Iterator[tuple[int, tuple[int, int], tuple[int, int] | None, int]]:
        """Nodes in depth-first order: position in the segment (0 for the root), key, parent's key, bitset.

        Nodes at the segment's start belong to the segment before, but for the root.
        """
        for base, bits in self.bases.items():
            if not self.seg:
                yield 0, base, None, bits
            stack = [(0, base, bits)]
            while stack:
                j, key, bits = stack.pop()
                rest = bits & self.here[j]
                while rest:
                    t = self.turns[(rest & -rest).bit_length() - 1][j]
                    child = rest & self.postings[j][t]
                    rest ^= child
                    below = (key[0] ^ t[0], key[1] ^ t[1])
                    yield j + 1, below, key, child
                    if j + 1 < len(self.postings):
                        stack.append((j + 1, below, child))

    def members(self, bits: int) -> list[int]:
        if bits.bit_count() < 8:
            out = []
            while bits:
                out.append((bits & -bits).bit_length() - 1)
                bits &= bits - 1
            return out
        raw = np.frombuffer(bits.to_bytes((len(self.rows) + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


def _shards(rows: DataFrame, schema: str, emit: Callable[[Shard], list[tuple]], segment: int, shard: int) -> DataFrame:
    """``emit`` of every shard: blocks of rows that follow each other in (segment, sequence before, first turn) order."""
    order = ["seg", "b1", "b2", "f1", "f2", "conv"]
    keyed = rows.withColumn("f1", F.expr("get(turns, 0).k1")).withColumn("f2", F.expr("get(turns, 0).k2"))
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("f1", "f2")
    arrow = pa.schema([(name, {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}[kind])
                       for name, kind in (c.split(" ") for c in schema.split(", "))])

    def run(batches):
        block: list[dict] = []

        def close():
            columns = list(zip(*emit(Shard(block, segment)))) or [()] * len(arrow)
            block.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for at in range(0, len(batch), shard):
                for row in batch.slice(at, shard).to_pylist():
                    if block and (len(block) == shard or block[0]["seg"] != row["seg"]):
                        yield close()
                    block.append(row)
        if block:
            yield close()

    return dealt.mapInArrow(run, schema)


def _nodes(shard: Shard) -> list[tuple]:
    """Depth, key, parent's key, members, smallest member, words of the last turn, end list."""
    out = []
    for j, key, parent, bits in shard.walk():
        first = (bits & -bits).bit_length() - 1
        ends = bits & shard.ends[j]
        out.append((shard.first + j, *key, *(parent or (None, None)), bits.bit_count(), shard.convs[first],
                    shard.words[first][j - 1] if j else 0, [shard.convs[i] for i in shard.members(ends)]))
    return out


def _sums(shard: Shard) -> list[tuple]:
    """Depth, key, members that own a leaf, words of members between the node and the first that each owns."""
    width = len(shard.postings) + 1
    leaves, shared = 0, [0] * width
    until = [r["shared"] for r in shard.rows]
    passed = []
    for i, row in enumerate(shard.rows):
        leaves |= (row["leaf"] or 0) << i
        passed.append(np.concatenate([[0], np.cumsum(shard.words[i], dtype=np.int64)]) + row["before"])
        for j in range(min(width, row["owned_from"] - shard.first)):
            shared[j] |= 1 << i
    out = []
    for j, key, _, bits in shard.walk():
        saved = sum(until[i] - int(passed[i][max(j - 1, 0)]) for i in shard.members(bits & shared[j]))
        out.append((shard.first + j, *key, (bits & leaves).bit_count(), saved))
    return out


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's sorted end list; lists are streamed, so their length does not matter."""
    open_key, state = None, None

    def close():
        return pa.RecordBatch.from_pydict({"depth": [open_key[0]], "k1": [open_key[1]], "k2": [open_key[2]], "ends_sha256": [state.hexdigest()]},
                                          schema=pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        ids = batch.column(3).to_pylist()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
        done = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            key, some = tuple(keys[a].tolist()), ",".join(map(str, ids[a:b])).encode()
            if key == open_key:
                state.update(b"," + some)
                continue
            if open_key is not None:
                done.append(close())
            open_key, state = key, hashlib.sha256(some)
        yield from (pa.Table.from_batches(done).combine_chunks().to_batches() if done else [])
    if open_key is not None:
        yield close()


def trie(turns: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """The prefix trie of ``turns`` (``conv``, ``pos``, ``turn_hash``, ``words``, ``length``).

    One row a node: ``conv_id``, its smallest member; ``depth``;
    ``parent_conv_id``; ``n_convs``, ``n_children``, ``n_leaves``;
    ``saved_tokens``, over its subtree, (members - 1) x words of the last turn;
    ``ends_sha256``, of the ids that end there, ascending, comma-joined.
    A row with ``pos`` 0 is a conversation without turns, which ends at the root.
    No conversations, no nodes.
    """
    cut = segments(turns, segment)
    found = stored(_shards(cut, "depth long, k1 long, k2 long, p1 long, p2 long, n long, conv long, words long, ends array<long>", _nodes,
                           segment, shard),
                   "trie-found")
    merged = found.groupBy(*KEY).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum("n").alias("n_convs"),
                                     F.min("conv").alias("conv"))
    merged = stored(merged, "trie-merged")
    children = merged.where("depth > 0").groupBy(F.expr("depth - 1").alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    nodes = stored(merged.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    owned = nodes.groupBy("conv").agg(F.count_if(F.col("depth") > 0).alias("owned"),
                                      F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    whole = Window.partitionBy("conv")
    before = whole.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    in_words = "aggregate(turns, 0L, (s, t) -> s + t.words)"
    known = cut.join(owned, "conv", "left").withColumn("owned_from", F.expr("length - coalesce(owned, 0L) + 1"))
    known = known.select(
        "conv", "seg", "length", "turns", "b1", "b2", "owned_from", F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.coalesce(F.sum(F.expr(in_words)).over(before), F.lit(0).cast("long")).alias("before"),
        F.sum(F.expr("aggregate(turns, 0L, (s, t) -> s + if(t.pos < owned_from, t.words, 0))")).over(whole).alias("shared"))
    sums = (_shards(stored(known, "trie-known"), "depth long, k1 long, k2 long, leaves long, saved long", _sums, segment, shard)
            .groupBy(*KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))

    ends = (found.where("size(ends) > 0").select(*KEY, F.explode("ends").alias("id"))
            .repartition(*KEY).sortWithinPartitions(*KEY, "id")
            .mapInArrow(_end_digests, "depth long, k1 long, k2 long, ends_sha256 string"))

    inner = nodes.where("n_children > 0").select(F.expr("depth + 1").alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                 F.col("conv").alias("parent_conv_id"), "n_children")
    crowded, _ = checked_broadcast(inner.where(F.col("n_children") > HOT).drop("n_children"))
    up = ["depth", "p1", "p2"]
    below = nodes.where("depth > 0")
    parents = (below.join(crowded, up)
               .unionByName(below.join(crowded, up, "left_anti").join(inner.where(F.col("n_children") <= HOT).drop("n_children"), up))
               .unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))))
    return parents.join(sums, KEY).join(ends, KEY, "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def crossed_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 **how) -> DataFrame:
    """The trie of ``crossed`` conversations; see ``trie`` for its columns.

    Rows with a null id take no part. Turns are ordered by ``turn``, null
    first, equal ones by their contents' hash; repeated rows are turns of
    their own. Null roles and texts are empty. An id that is no integer is
    refused. An empty table gives no rows. Other columns are not read.
    """
    return trie(crossed(stored(turn_rows(conversations, conv_id, turn, role, text), "trie-turns")), **how)
