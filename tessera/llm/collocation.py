"""Collocations from count streams in prefix order and in suffix order.

Counting and scoring are passes over sorted streams of phrases, in the way
large n-gram models are estimated out of memory:

1. *Words.* Tasks count the words of a block of text and combine them.
2. *Skipping.* No phrase is more frequent than a pair of neighbours in it. A
   bitmap of fixed size marks the keys of frequent words, then of frequent
   pairs; text is cut where a key is not marked. It only skips work: a key that
   is marked by chance costs a count, and no count is taken from it.
3. *Counts.* Every position gives the window of up to ``longest`` words that
   starts there. Windows are combined per block and dealt by ranges of their
   order, so a frequent first word spreads over tasks. In the sorted stream, the
   occurrences of a phrase are the windows that begin with it: a run. Runs
   that touch a border of a range are summed with the next range's.
4. *Prefix and suffix order.* The frequent phrases are sorted once by their
   words from the left and once from the right. In the first stream the
   last phrase of k words is the beginning of what follows, so one pass gives the
   counts of all beginnings; the second gives those of all ends. What a range
   needs from before its border is one row a length.
5. *Lockstep.* Both streams are merge-joined phrase by phrase. A phrase with its
   beginning's or its end's count is the extension that covers it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import column_bytes, mix, row_slices, stored, word_hashes
from tessera.operators.joins import checked_broadcast

TEXT_BYTES = 1 << 20  # text counted at a time by a task
HELD_BYTES = 1 << 24  # keys and counts that a task sums before it hands them on
FILTER_BITS = 1 << 27  # bits of a bitmap of frequent keys: 16 MiB, whatever the input
_BUCKET = 8 * 4096  # bits of one bitmap of Spark's bitmap functions
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?") + [10, 11, 12, 13]] = True
_WORD = ~_BREAK
_WORD[[9, 32]] = False
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The words of a block of texts: ``names`` are the distinct ones, ``which`` the occurrences.

    ``lang`` is the language's number of each occurrence, ``joined`` tells
    whether it and the next one stand in one piece of one text.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        raw = _LOWER[raw]
        word = np.zeros(len(raw) + 2, bool)
        word[1:-1] = _WORD[raw]
        inner = np.zeros(len(raw) + 1, bool)
        inner[offsets] = True
        starts = np.flatnonzero(word[1:-1] & (~word[:-2] | inner[:-1]))
        ends = np.flatnonzero(word[1:-1] & (~word[2:] | inner[1:])) + 1
        rows = np.searchsorted(offsets, starts, "right") - 1
        pieces = np.cumsum(_BREAK[raw], dtype=np.int32)[starts] if len(raw) else np.zeros(0, np.int32)
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (rows[1:] == rows[:-1]) & (pieces[1:] == pieces[:-1])
        self.lang = langs[rows]
        cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        data = raw[word[1:-1]]
        names = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        coded = names.dictionary_encode()
        self.which, self.names = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())

    def keys(self, langs: list[str]) -> np.ndarray:
        """A 64-bit key of each occurrence's language and word."""
        data, offsets = column_bytes(self.names)
        word = word_hashes(data, offsets[:-1], offsets[1:]) if len(self.names) else np.zeros(0, np.uint64)
        lang = np.array([xxhash.xxh64_intdigest(name) for name in langs], np.uint64)
        return mix(word[self.which] * _LEFT + lang[self.lang])


def _blocks(batches: Iterator[pa.RecordBatch], text_bytes: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of blocks of whole texts, and the names of their languages; columns are lang, text."""
    for batch in batches:
        for at, raw, offsets in row_slices(batch.column(1), text_bytes):
            langs = batch.column(0).slice(at, len(offsets) - 1).dictionary_encode()
            words = Words(raw, offsets, langs.indices.to_numpy())
            if len(words.which):
                yield words, langs.dictionary.to_pylist()


def _word_counts(words: Words, langs: list[str]) -> pa.RecordBatch:
    code, first, n = np.unique(words.lang.astype(np.int64) * len(words.names) + words.which, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(langs).take(pa.array(words.lang[first])), words.names.take(pa.array(words.which[first])),
         pa.array(words.keys(langs)[first].view(np.int64)), pa.array(n, pa.int64())], names=["lang", "word", "key", "n"])


class Marked:
    """A bitmap of frequent keys."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = keys & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def mark(counts: DataFrame, least: int, bits: int) -> bytes:
    """The bitmap of the keys (``key``) that have at least ``least`` occurrences (``n``) in all.

    Its size is fixed, so is what the driver receives.
    """
    frequent = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    at = F.col("key").bitwiseAND(F.lit(bits - 1)) + 1
    # Keys are brought together by bitmap before it is made, so that keys are shuffled and no half-empty bitmaps.
    place = frequent.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")).repartition("bucket")
    out = bytearray(bits // 8)
    for row in place.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect():
        out[(row.bucket - 1) * 4096:row.bucket * 4096] = row.bitmap
    return bytes(out)


def _pair_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the pairs of neighbours; the last occurrence has none."""
    out = np.zeros(len(keys), np.uint64)
    out[:-1] = mix(keys[:-1] * _LEFT + keys[1:] * _RIGHT)
    return out


def _windows(words: Words, linked: np.ndarray, longest: int, langs: list[str]) -> pa.Table:
    """The distinct windows of 2 to ``longest`` words along links, and how often each starts somewhere."""
    at = np.flatnonzero(linked)
    matrix = np.full((len(at), longest), -1, np.int32)
    going = np.ones(len(at), bool)
    matrix[:, 0] = words.which[at]
    for k in range(1, longest):
        going &= linked[np.minimum(at + k - 1, len(linked) - 1)] & (at + k < len(linked))
        matrix[going, k] = words.which[at[going] + k]
    lang = words.lang[at]
    order = np.lexsort([*matrix.T[::-1], lang])
    matrix, lang = matrix[order], lang[order]
    new = np.ones(len(at), bool)
    new[1:] = (matrix[1:] != matrix[:-1]).any(axis=1) | (lang[1:] != lang[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    matrix = matrix[first]
    filled = matrix >= 0
    cuts = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32)
    phrase = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words.names.take(pa.array(matrix[filled]))), " ")
    return pa.table([pa.array(langs).take(pa.array(lang[first])), phrase, pa.array(n, pa.int64())], names=["lang", "phrase", "n"])


def _summed(tables: Iterator[pa.Table], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sums of ``n`` by ``keys`` over as many tables as ``HELD_BYTES`` allows; phrases are of any length, so rows would not bound them."""
    def close():
        one = pa.concat_tables(held)
        return one if len(held) == 1 else one.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

    held: list[pa.Table] = []
    for table in tables:
        held.append(table)
        if sum(t.nbytes for t in held) > HELD_BYTES:
            held = [close()]
            if held[0].nbytes > HELD_BYTES // 2:
                yield from held[0].to_batches(max_chunksize=1 << 16)
                held = []
    if held:
        yield from close().to_batches(max_chunksize=1 << 16)


class Stream:
    """A batch of a sorted stream of phrases, as numbers: ``size``, ``matrix`` of words, ``lang``."""

    def __init__(self, batch: pa.RecordBatch, longest: int):
        self.batch = batch
        column = batch.column(batch.schema.get_field_index("words"))
        offsets = column.offsets.to_numpy()
        self.size = np.diff(offsets)
        coded = column.flatten().dictionary_encode()
        self.names = coded.dictionary
        self.matrix = np.full((len(self.size), longest), -1, np.int32)
        self.matrix[np.arange(longest) < self.size[:, None]] = coded.indices.to_numpy()
        lang = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
        self.lang, self.langs = lang.indices.to_numpy(), lang.dictionary

    def phrase(self, row: int, k: int) -> tuple:
        return (self.langs[int(self.lang[row])].as_py(), *(self.names[int(w)].as_py() for w in self.matrix[row, :k]))


def _phrase_batch(rows: list[tuple[tuple, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"lang": [p[0] for p, _ in rows], "words": [list(p[1:]) for p, _ in rows], "f": [n for _, n in rows]},
        schema=pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64())]))


def _runs(least: int, longest: int):
    """Counts of the phrases that the windows of a sorted range begin with.

    Runs inside the range below ``least`` go; those that touch its borders stay,
    as their other parts are in the next ranges.
    """
    def run(batches):
        held: dict[int, tuple] = {}  # by length: phrase, count and whether it is the range's first
        for batch in batches:
            if not batch.num_rows:
                continue
            stream, n, some = Stream(batch, longest), batch.column(2).to_numpy(), []
            for k in range(2, longest + 1):
                rows = np.flatnonzero(stream.size >= k)
                if not len(rows):
                    continue
                new = np.ones(len(rows), bool)
                a, b = rows[1:], rows[:-1]
                new[1:] = (stream.matrix[a, :k] != stream.matrix[b, :k]).any(axis=1) | (stream.lang[a] != stream.lang[b])
                first = np.flatnonzero(new)
                sums = np.add.reduceat(n[rows], first)
                begins, edge = stream.phrase(int(rows[0]), k), k not in held
                if not edge:
                    phrase, count, edge = held[k]
                    if phrase == begins:
                        sums[0] += count
                    else:
                        if edge or count >= least:
                            some.append((phrase, count))
                        edge = False
                if len(first) > 1:
                    if edge:
                        some.append((begins, int(sums[0])))
                    keep = np.flatnonzero(sums[:-1] >= least)
                    some += [(stream.phrase(int(rows[first[i]]), k), int(sums[i])) for i in keep if i or not edge]
                    edge = False
                held[k] = (stream.phrase(int(rows[first[-1]]), k), int(sums[-1]), edge)
            if some:
                yield _phrase_batch(some)
        if held:
            yield _phrase_batch([(phrase, count) for phrase, count, _ in held.values()])
    return run


def frequent_phrases(docs: DataFrame, least: int, longest: int, lang: str = "lang", text: str = "text",
                     filter_bits: int = FILTER_BITS, text_bytes: int = TEXT_BYTES) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words with at least ``least`` occurrences, and the words of each language.

    The first table has ``lang``, ``words`` and ``f``, the second ``lang`` and ``n``.
    """
    if filter_bits % _BUCKET or filter_bits & (filter_bits - 1):
        raise ValueError(f"filter_bits must be a power of two, {_BUCKET} at least")
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))

    def singles(batches):
        return (_word_counts(*block) for block in _blocks(batches, text_bytes))

    words = stored(rows.mapInArrow(singles, "lang string, word string, key long, n long")
                   .groupBy("lang", "word", "key").agg(F.sum("n").alias("n")), "phrase-words")
    frequent_words = context.broadcast(mark(words, least, filter_bits))

    def pairs(batches):
        return _summed(pair_counts(batches), ["key"])

    def pair_counts(batches):
        marked = Marked(frequent_words.value)
        for block, langs in _blocks(batches, text_bytes):
            keys = block.keys(langs)
            good = marked(keys)
            link = block.joined.copy()
            link[:-1] &= good[:-1] & good[1:]
            key, n = np.unique(_pair_keys(keys)[link], return_counts=True)
            yield pa.table([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    frequent_pairs = context.broadcast(mark(rows.mapInArrow(pairs, "key long, n long"), least, filter_bits))

    def windows(batches):
        return _summed(window_counts(batches), ["lang", "phrase"])

    def window_counts(batches):
        marked, paired = Marked(frequent_words.value), Marked(frequent_pairs.value)
        for block, langs in _blocks(batches, text_bytes):
            keys = block.keys(langs)
            good = marked(keys)
            link = block.joined & paired(_pair_keys(keys))
            link[:-1] &= good[:-1] & good[1:]
            if link.any():
                yield _windows(block, link, longest, langs)

    # Written once: dealing by ranges reads its rows twice, for the borders and for the rows.
    counted = stored(rows.mapInArrow(windows, "lang string, phrase string, n long"), "phrase-windows")
    for bitmap in (frequent_words, frequent_pairs):
        bitmap.unpersist()  # no later step reads them; executors need not hold them
    parts = (counted.select("lang", F.split("phrase", " ").alias("words"), "n").repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
             .mapInArrow(_runs(least, longest), "lang string, words array<string>, f long"))
    phrases = parts.groupBy("lang", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    single = words.where(F.col("n") >= least).select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    return stored(phrases.unionByName(single), "phrases"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def beginnings(phrases: DataFrame, longest: int) -> DataFrame:
    """``phrases`` (``lang``, ``words``, ``f``) plus ``counts``: f of the first 1, 2, ... words, the last left out.

    One pass over the sorted phrases. Every beginning of a phrase must be in the table.
    """
    def run(batches):
        part, last = TaskContext.get().partitionId(), [None] * longest
        for batch in batches:
            if not batch.num_rows:
                continue
            stream, f = Stream(batch, longest), batch.column(2).to_numpy()
            n = len(f)
            table, known = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
            for k in range(1, longest):
                seen = np.maximum.accumulate(np.where(stream.size == k, np.arange(n), -1))
                here = seen >= 0
                table[here, k - 1], known[here, k - 1] = f[seen[here]], True
                if last[k] is not None:
                    table[~here, k - 1], known[~here, k - 1] = last[k], True
                if here[-1]:
                    last[k] = int(f[seen[-1]])
            wanted = np.arange(longest) < stream.size[:, None] - 1
            cuts = np.concatenate([[0], np.cumsum(wanted.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(table[wanted], pa.int64(), mask=~known[wanted])),
                 pa.array(np.full(n, part, np.int32))], names=["lang", "words", "f", "counts", "part"])

    passed = stored(phrases.select("lang", "words", "f").repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
                    .mapInArrow(run, "lang string, words array<string>, f long, counts array<long>, part int"), "phrase-stream")
    # A beginning that stands before a range's border is the same for all rows of the range that lack it.
    gaps = (passed.where("exists(counts, c -> c is null)")
            .select("part", "lang", "words", F.posexplode("counts").alias("i", "c")).where("c is null")
            .groupBy("part", "i").agg(F.first(F.struct("lang", F.expr("slice(words, 1, i + 1)").alias("words"))).alias("p")))
    found = (gaps.join(phrases.select(F.col("lang").alias("l"), F.col("words").alias("w"), F.col("f").alias("v")),
                       (F.col("p.lang") == F.col("l")) & (F.col("p.words") == F.col("w")))
             .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("i", "v"))).alias("carried")))
    # One row a range at most.
    found, _ = checked_broadcast(found)
    return passed.join(found, "part", "left").select(
        "lang", "words", "f", F.expr("transform(counts, (c, i) -> coalesce(c, carried[i]))").alias("counts"))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, covered_percent: int = 100,
                 lang: str = "lang", text: str = "text", **how) -> DataFrame:
    """Each language's ``top`` phrases by how much more often their parts meet than by chance.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line
    ends, and these into words at blanks and tabs. A phrase of 2 to
    ``longest`` words with a >= ``least`` occurrences is cut in two at every place; with l
    and r occurrences of the parts and n words of the language, the lowest
    floor(1000 a n / (l r)) is its score, the first such cut its cut. A phrase
    goes if one that contains it has ``covered_percent`` of its occurrences.
    Ranked by score and a, descending, then by the phrase's bytes.

    Returns ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``,
    ``score``. A null language is ``und``, as is that name; null and empty
    texts have no words; repeated rows count each time; an empty table gives
    no rows. Other columns are not read. Products are decimals of 38 digits.
    """
    phrases, totals = frequent_phrases(docs, least, longest, lang, text, **how)
    left = beginnings(phrases, longest).where("size(words) > 1")
    right = beginnings(phrases.select("lang", F.reverse("words").alias("words"), "f"), longest).where("size(words) > 1").select(
        F.col("lang").alias("rlang"), F.reverse("words").alias("rwords"), F.col("counts").alias("ends"))
    both = stored(left.join(right.hint("merge"), (left.lang == right.rlang) & (left.words == right.rwords))
                  .select("lang", "words", "f", F.col("counts").alias("begins"), "ends"), "phrase-parts")
    # An extension of one word covers a phrase if any does: counts do not grow with length.
    longer = both.where("size(words) > 2").select("lang", "f", F.explode(F.array(
        F.struct(F.expr("slice(words, 1, size(words) - 1)").alias("words"), F.element_at("begins", -1).alias("f")),
        F.struct(F.expr("slice(words, 2, size(words) - 1)").alias("words"), F.element_at("ends", -1).alias("f")))).alias("part"))
    covered = longer.where(F.col("f") * 100 >= F.col("part.f") * covered_percent).select(
        F.col("lang").alias("clang"), F.col("part.words").alias("cwords")).distinct()
    totals, _ = checked_broadcast(totals)
    whole = "cast({} as decimal(38, 0))"
    score = f"1000BD * {whole.format('f')} * {whole.format('n')} div ({whole.format('begins[k - 1]')} * {whole.format('ends[size(words) - k - 1]')})"
    scored = (both.join(covered.hint("merge"), (both.lang == F.col("clang")) & (both.words == F.col("cwords")), "left_anti")
              .join(totals, "lang")
              .select("lang", F.concat_ws(" ", "words").alias("phrase"), F.col("f").alias("a"), "n", F.expr(
                  "array_min(transform(sequence(1, size(words) - 1), k -> named_struct('score', "
                  f"{score}, 'k', k, 'l', begins[k - 1], 'r', ends[size(words) - k - 1])))").alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
