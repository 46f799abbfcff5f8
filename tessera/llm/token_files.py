"""Token files: flat unsigned identifiers plus 64-bit document offsets, read through memory maps.

A data set is a folder of parts. A part is three flat little-endian files:

* ``.ids``: the identifiers of its documents, one after the other, 2 or 4 bytes each;
* ``.offsets``: an unsigned 64-bit integer a document and one more, where each
  document begins in the part and where the last one ends, in identifiers;
* ``.docs``: a signed 64-bit document id each (0 for a null one; these come
  first, and the part's row says how many there are).

Parts hold ascending ranges of document ids. The table of parts gives every
part its base, the number of identifiers and of documents in all parts before
it: a prefix sum over one row a part, so no task needs to know what the others
wrote while it writes. A document's place in the whole stream is the base of
its part plus its own offset.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tessera.llm.common import column_bytes, stored
from tessera.llm.warc import open_fs

TEXT_BYTES = 4 << 20  # text encoded at a time by a task
CACHED = 1 << 20  # encoded words, and a quarter of their identifiers, that a worker keeps
SUPER = 1024  # parts that are summed together in the first level of the prefix sum
PARTS = "path string, part int, width int, docs long, nulls long, ids long"


def id_width(vocabulary: int) -> int:
    """Bytes of an identifier of a vocabulary of that size."""
    return 2 if vocabulary <= 1 << 16 else 4


class Encoder:
    """A tokenizer and the identifiers of what it has encoded, within ``CACHED``."""

    def __init__(self, tokenizer: Tokenizer, end: int):
        # Tasks are the parallel units; threads of a task would take other tasks' cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.end = tokenizer, end
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.sizes, self.flat = array("q", [1]), array("I", [self.end])

    def numbers(self, texts: list[str], plain_words: bool) -> np.ndarray:
        """The number of each of some distinct texts; number 0 is the end identifier alone."""
        if self.number and max(len(self.number) + len(texts), len(self.flat) // 4) > CACHED:
            self.clear()
        number, sizes, flat, merge = self.number, self.sizes, self.flat, self.tokenizer.model.tokenize
        rest, marks = [], {}
        for t in texts:
            if t in number:
                continue
            # ASCII letters, then perhaps marks: two pieces that the model can merge at once.
            letters = t.rstrip(".,;:!?") if plain_words and t.isascii() else ""
            if not letters.isalpha():
                rest.append(t)
                continue
            ids = [token.id for token in merge(letters.lower())]
            if len(letters) < len(t):
                after = t[len(letters):]
                if after not in marks:
                    marks[after] = self.tokenizer.encode(after, add_special_tokens=False).ids
                ids += marks[after]
            number[t] = len(sizes)
            sizes.append(len(ids))
            flat.extend(ids)
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            for t, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                number[t] = len(sizes)
                ids = e.ids
                sizes.append(len(ids))
                flat.extend(ids)
        return np.fromiter(map(number.__getitem__, texts), np.int64, len(texts))

    def encode(self, texts: pa.Array, by_words: bool, plain_words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, each followed by the end, and how many each text has.

        ``by_words`` encodes each distinct run of characters between ASCII
        white space once, and puts the texts together from these. That equals
        encoding whole texts for a tokenizer none of whose pieces holds or
        crosses white space. ``plain_words`` gives runs of ASCII letters to
        the tokenizer's model directly; that equals the rest of its steps if
        it lower-cases, and letters and the marks ``. , ; : ! ?`` behind
        them are a piece each. For any other tokenizer, leave them out.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        if by_words:
            words = pc.ascii_split_whitespace(texts)
            starts = words.offsets.to_numpy().astype(np.int64)
            words, starts = words.flatten().dictionary_encode(), starts - starts[0]
            which = self.numbers(words.dictionary.to_pylist(), plain_words)[words.indices.to_numpy()]
        else:
            self.clear()
            coded, starts = texts.dictionary_encode(), np.arange(len(texts) + 1)
            which = self.numbers(coded.dictionary.to_pylist(), False)[coded.indices.to_numpy()]
        which = np.insert(which, starts[1:], 0)
        sizes, flat = np.frombuffer(self.sizes, np.int64), np.frombuffer(self.flat, np.uint32)
        firsts = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        stops = np.cumsum(lengths)
        at = np.arange(stops[-1] if len(stops) else 0) + np.repeat(firsts[which] - (stops - lengths), lengths)
        edges = np.concatenate([[0], stops])[starts + np.arange(len(starts))]
        out = flat[at]
        del sizes, flat  # the arrays can grow again
        return out, np.diff(edges)


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(model: str, end: int) -> Encoder:
    """The worker's encoder of that model: a worker serves many tasks."""
    if (model, end) not in _encoders:
        _encoders.clear()
        _encoders[model, end] = Encoder(Tokenizer.from_str(model), end)
    return _encoders[model, end]


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``TEXT_BYTES`` bytes; a longer text is a range of its own."""
    offsets = column_bytes(texts)[1]
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TEXT_BYTES, "right")) - 1)
        yield at, min(to, n)
        at = to


class _Part:
    """The three files of one attempt of a task."""

    def __init__(self, folder: str, width: int):
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        self.part = TaskContext.get().partitionId()
        name = f"part-{self.part:06d}-{uuid.uuid4().hex}"
        self.path, self.width = f"{folder.rstrip('/')}/{name}", width
        self.out = {kind: fs.open_output_stream(f"{base}/{name}.{kind}", compression=None) for kind in ("ids", "offsets", "docs")}
        self.out["offsets"].write(np.zeros(1, "<u8").tobytes())
        self.docs = self.nulls = self.ids = 0

    def write(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.out["ids"].write(ids.astype(f"<u{self.width}").tobytes())
        self.out["offsets"].write((np.cumsum(lengths) + self.ids).astype("<u8").tobytes())
        self.out["docs"].write(doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
        self.docs, self.nulls, self.ids = self.docs + len(lengths), self.nulls + doc_ids.null_count, self.ids + int(lengths.sum())

    def close(self) -> pa.RecordBatch:
        for out in self.out.values():
            out.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.path]), pa.array([self.part], pa.int32()), pa.array([self.width], pa.int32()),
             *(pa.array([v], pa.int64()) for v in (self.docs, self.nulls, self.ids))],
            names=["path", "part", "width", "docs", "nulls", "ids"])


def with_bases(parts: DataFrame) -> DataFrame:
    """``parts`` plus ``base_ids`` and ``base_docs``: sums over all parts before each.

    Two levels, so that no task sums more than ``SUPER`` rows or super rows at a time.
    """
    rows = parts.withColumn("super", F.expr(f"part div {SUPER}"))
    inside = Window.partitionBy("super").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = rows.groupBy("super").agg(F.sum("ids").alias("ids"), F.sum("docs").alias("docs")).select(
        "super", *[F.coalesce(F.sum(c).over(across), F.lit(0)).alias(f"super_{c}") for c in ("ids", "docs")])
    summed = rows.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"in_{c}") for c in ("ids", "docs")])
    return summed.join(supers, "super").select(
        *parts.columns, *[(F.col(f"super_{c}") + F.col(f"in_{c}")).alias(f"base_{c}") for c in ("ids", "docs")])


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int, by_words: bool = False,
                      plain_words: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode ``docs`` into parts under ``folder``, in ascending order of document ids.

    ``tokenizer`` is a file of the tokenizers library; its contents are sent
    to the tasks. Strings of its special tokens in a text become these tokens,
    as the library does by default. ``by_words`` and ``plain_words`` are
    ``Encoder.encode``'s. Returns the table of parts: ``path``
    (without the file kind), ``part``, ``width``, ``docs``, ``nulls``, ``ids``,
    ``base_ids`` and ``base_docs``. Spark commits it, so it names only files
    of attempts that count.

    Null ids come first; rows of one id are ordered by their texts' hashes,
    and repeated rows all stay, dealt over ranges like any others. A null or
    empty text is the end identifier alone. A document id that is no integer
    is refused. An empty table has no parts. Other columns are not read.
    """
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id} must be an integer column")
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    vocabulary = Tokenizer.from_str(model).get_vocab_size()
    width = id_width(max(vocabulary, end + 1))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    # The last key deals repeated rows; it is the same whenever a task reads its split again.
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("salt")]
    ranged = rows.withColumn("salt", F.rand(11)).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")

    def run(batches):
        encoder, part = _encoder(sent.value, end), None
        for batch in batches:
            for at, to in _runs(batch.column(1)):
                if part is None:
                    part = _Part(folder, width)
                ids, lengths = encoder.encode(batch.column(1).slice(at, to - at), by_words, plain_words)
                part.write(batch.column(0).slice(at, to - at), ids, lengths)
        if part is not None:
            yield part.close()

    return stored(with_bases(stored(ranged.mapInArrow(run, PARTS), "token-parts")), "token-bases")


def mapped(path: str, kind: str, start: int, n: int) -> np.ndarray:
    """``n`` integers of a flat file from ``start`` on: a view of a memory map where the file system has one."""
    fs, name = open_fs(path)
    dtype = np.dtype(kind)
    if not n:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(name, dtype, "r", start * dtype.itemsize, (n,))
    with fs.open_input_file(name) as file:
        return np.frombuffer(file.read_at(n * dtype.itemsize, start * dtype.itemsize), dtype)


class TokenPart:
    """Random access to the documents of one part."""

    def __init__(self, path: str, width: int, docs: int, nulls: int, base_ids: int = 0, base_docs: int = 0, **_):
        self.path, self.kind, self.docs, self.nulls = path, f"<u{width}", docs, nulls
        self.base_ids, self.base_docs = base_ids, base_docs

    def offsets(self, first: int, n: int) -> np.ndarray:
        return mapped(f"{self.path}.offsets", "<u8", first, n + 1).astype(np.int64)

    def doc_ids(self, first: int, n: int) -> np.ma.MaskedArray:
        ids = np.asarray(mapped(f"{self.path}.docs", "<i8", first, n))
        return np.ma.masked_array(ids, np.arange(first, first + n) < self.nulls)

    def ids(self, start: int, stop: int) -> np.ndarray:
        return mapped(f"{self.path}.ids", self.kind, start, stop - start)

    def document(self, i: int) -> np.ndarray:
        a, b = self.offsets(i, 1)
        return self.ids(a, b)


def read_documents(parts: DataFrame, slice_docs: int = 1 << 12) -> DataFrame:
    """``doc_id``, ``position`` (in the data set), ``start``, ``n_tokens`` and ``ids_crc32`` of every document.

    Read from the files alone; a task reads ``slice_docs`` documents of a
    part at a time, so a part of any size spreads over tasks. The checksum is
    of a document's identifiers as little-endian unsigned 32-bit integers.
    """
    slices = parts.where("docs > 0").select("*", F.explode(F.expr(f"sequence(0L, docs - 1, {slice_docs}L)")).alias("first"))
    slices = slices.repartition(max(1, min(100_000, slices.count())))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part, first = TokenPart(**row), row["first"]
                n = min(slice_docs, part.docs - first)
                edges, names = part.offsets(first, n), part.doc_ids(first, n)
                ids = memoryview(part.ids(edges[0], edges[-1]).astype("<u4").view(np.uint8))
                sums = [zlib.crc32(ids[a:b]) for a, b in pairwise(((edges - edges[0]) * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.data, pa.int64(), mask=np.ma.getmaskarray(names)),
                     pa.array(np.arange(first, first + n) + part.base_docs, pa.int64()),
                     pa.array(edges[:-1] + part.base_ids, pa.int64()), pa.array(np.diff(edges), pa.int64()),
                     pa.array(sums, pa.int64())],
                    names=["doc_id", "position", "start", "n_tokens", "ids_crc32"])

    return slices.mapInArrow(run, "doc_id long, position long, start long, n_tokens long, ids_crc32 long")
