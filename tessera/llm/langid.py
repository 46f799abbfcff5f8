"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A text's score in a language is the sum of the probabilities of all its
segmentations into pieces, computed by the forward algorithm. Segmentations
do not cross words, so a text's log score is the sum over its words, and each
distinct word of a task is scored once, together with the other words of its
length. Piece probabilities are fitted by expectation maximisation: expected
piece counts over all segmentations, from forward and backward sums.

Words are runs without white space that hold a letter, lower-cased, with a
leading space as in the vocabulary. Words of up to 64 bytes are summed together
with those of their length, longer ones one at a time with memory for one run
of positions; both sum over all segmentations of the whole word.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import mix, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PART = 64
UND = "und"
_BASE = 0xD1342543DE82EF95
_HASH_BITS = 22
_GROUP = 1 << 15
_RESCALE = 12
_KEEP = 400_000
_RUN = 4096


def read_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces that can occur in a word, in the file's order."""
    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    space = set(b"\t\n\x0b\x0c\r ")
    return [p for p in pieces if len(p) <= PART and not space.intersection(p[1:]) and p[0] not in space - {32}]


def _hash_columns(words: np.ndarray) -> np.ndarray:
    """Running polynomial hashes: column i covers the first i bytes."""
    n, size = words.shape
    sums = np.zeros((size + 1, n), np.uint64)
    power = 1
    for i in range(size):
        sums[i + 1] = sums[i] + (words[:, i].astype(np.uint64) + np.uint64(1)) * np.uint64(power)
        power = power * _BASE % (1 << 64)
    return sums


class Lattice:
    """Finds the vocabulary's pieces in words and sums over segmentations."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces))
        self.down = np.array([pow(_BASE, -i, 1 << 64) for i in range(PART + 2)], np.uint64)
        keys = np.zeros(len(pieces), np.uint64)
        for size in range(1, self.longest + 1):
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            if at:
                words = np.frombuffer(b"".join(pieces[i] for i in at), np.uint8).reshape(-1, size)
                keys[at] = mix(_hash_columns(words)[size])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.lengths = sorted({len(p) for p in pieces})
        self.maybe = np.zeros(1 << _HASH_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - _HASH_BITS)] = True
        n = _RUN + 2 * self.longest + 2
        self.powers = np.array([pow(_BASE, i, 1 << 64) for i in range(n)], np.uint64)
        self.inverse = np.array([pow(_BASE, -i, 1 << 64) for i in range(n)], np.uint64)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are pieces, and of which number."""
        at = np.flatnonzero(self.maybe[keys >> np.uint64(64 - _HASH_BITS)])
        found = np.searchsorted(self.keys, keys[at])
        found[found == len(self.keys)] = 0
        right = self.keys[found] == keys[at]
        return at[right], self.order[found[right]]

    def edges(self, words: np.ndarray):
        """Yield ``end, length, word numbers, piece numbers`` by growing end."""
        sums = _hash_columns(words)
        size = words.shape[1]
        for end in range(1, size + 1):
            for length in self.lengths:
                if length > end:
                    break
                keys = mix((sums[end] - sums[end - length]) * self.down[end - length])
                at, piece = self._find(keys)
                if len(at):
                    yield end, length, at, piece

    def _steps(self, word: np.ndarray, lo: int, hi: int, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of one word whose walk ends at lo + 1 to hi: end of the walk, length, piece, by end.

        A walk counts bytes from the word's front, or from its back.
        """
        size, out = len(word), []
        base = size - hi if back else max(0, lo + 1 - self.longest)
        part = word[base:min(size, size - lo + self.longest) if back else hi]
        sums = np.r_[np.uint64(0), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[:len(part)])]
        for length in self.lengths:
            walk = np.arange(max(lo + 1, length), hi + 1)
            start = (size - walk if back else walk - length) - base
            at, piece = self._find(mix((sums[start + length] - sums[start]) * self.inverse[start]))
            out.append((walk[at], np.full(len(at), length), piece))
        walk, length, piece = (np.concatenate(c) for c in zip(*out))
        order = np.argsort(walk, kind="stable")
        return walk[order], length[order], piece[order]

    def walk(self, word: np.ndarray, probability: np.ndarray, back: bool = False, keep: bool = False) -> np.ndarray:
        """Log of the sum over all segmentations of one word of any length, for each language.

        With ``keep`` the sums of every position's walk, from the word's front or its back.
        """
        size, reach = len(word), self.longest
        sums = np.zeros((reach + _RUN + 1, probability.shape[1]))
        sums[reach], scale = 1.0, np.zeros(probability.shape[1])
        logs = np.zeros((size + 1, probability.shape[1])) if keep else None
        for lo in range(0, size, _RUN):
            hi = min(size, lo + _RUN)
            ends, length, piece = self._steps(word, lo, hi, back)
            cut = np.searchsorted(ends, np.arange(lo + 1, hi + 2)).tolist()
            weight, source = probability[piece], ends - length - lo + reach
            for i in range(hi - lo):
                row, a, b = i + 1 + reach, cut[i], cut[i + 1]
                sums[row] = (sums[source[a:b]] * weight[a:b]).sum(axis=0)
                if i % _RESCALE == 0:
                    top = sums[row].copy()
                    scale += np.log(top)
                    sums[row - reach:row + 1] /= top
                if keep:
                    logs[lo + i + 1] = np.log(sums[row]) + scale
            sums[:reach + 1] = sums[hi - lo:hi - lo + reach + 1].copy()
        return logs if keep else np.log(sums[reach]) + scale

    def expected_long(self, word: np.ndarray, count: float, probability: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in one word of any length, for one language."""
        size, total = len(word), np.zeros(len(probability))
        front, back = (self.walk(word, probability[:, None], side, keep=True)[:, 0] for side in (False, True))
        for lo in range(0, size, _RUN):
            ends, length, piece = self._steps(word, lo, min(size, lo + _RUN), False)
            use = np.exp(front[ends - length] + np.log(probability[piece]) + back[size - ends] - front[size])
            np.add.at(total, piece, count * use)
        return total

    def forward(self, words: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations, for each word and language."""
        n, size = words.shape
        alpha = np.zeros((size + 1, n, probability.shape[1]))
        alpha[0] = 1.0
        scale = np.zeros(alpha.shape[1:])
        now = 1
        for end, length, at, piece in self.edges(words):
            if end != now:
                if now % _RESCALE == 0:
                    top = alpha[now].copy()
                    scale += np.log(top)
                    alpha[max(0, now - self.longest):now + 1] /= top
                now = end
            alpha[end, at] += alpha[end - length, at] * probability[piece]
        return np.log(alpha[size]) + scale

    def expected(self, words: np.ndarray, counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, for one language."""
        n, size = words.shape
        edges = list(self.edges(words))
        # One factor a byte keeps the sums in range; a word's factors cancel in the ratio below.
        growth = 30.0 ** np.arange(self.longest + 1)
        p = probability
        alpha, beta = np.zeros((size + 1, n)), np.zeros((size + 1, n))
        alpha[0], beta[size] = 1.0, 1.0
        for end, length, at, piece in edges:
            alpha[end, at] += alpha[end - length, at] * (p[piece] * growth[length])
        total = np.zeros(len(probability))
        share = counts / alpha[size]
        for end, length, at, piece in reversed(edges):
            use = p[piece] * growth[length] * beta[end, at]
            np.add.at(total, piece, alpha[end - length, at] * use * share[at])
            beta[end - length, at] += use
        return total


def word_bytes(word: str) -> bytes:
    return b" " + word.encode("utf-8", "replace")


def _groups(words: list[bytes]):
    """Words of one length together: their numbers and a byte matrix; longer ones than ``PART`` are left out."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) <= PART:
            by.setdefault(len(w), []).append(i)
    for size, at in by.items():
        for k in range(0, len(at), _GROUP):
            some = at[k:k + _GROUP]
            yield some, np.frombuffer(b"".join(words[i] for i in some), np.uint8).reshape(-1, size)


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


class Scorer:
    """Scores of words in all languages; remembers the words it has met, up to a bound."""

    def __init__(self, pieces: list[bytes], probability: np.ndarray):
        self.lattice, self.probability = Lattice(pieces), probability
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1, self.probability.shape[1]))
        self.sizes = np.zeros(1, np.int64)

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log score of each text, its number of words with a letter, and their median log score a byte in the best language."""
        if len(self.number) > _KEEP:
            self.forget()
        number, new, rows = self.number, [], []
        for text in texts:
            words = (text or "").lower().split()
            for w in set(words).difference(number):
                if has_letter(w):
                    number[w] = len(self.scores) + len(new)
                    new.append(w)
                else:
                    number[w] = 0
            rows.append([number[w] for w in words])
        if new:
            data, score = [word_bytes(w) for w in new], np.zeros((len(new), self.probability.shape[1]))
            for at, matrix in _groups(data):
                score[at] = self.lattice.forward(matrix, self.probability)
            for i, word in enumerate(data):
                if len(word) > PART:
                    score[i] = self.lattice.walk(np.frombuffer(word, np.uint8), self.probability)
            self.scores = np.concatenate([self.scores, score])
            self.sizes = np.r_[self.sizes, np.array([len(word) for word in data], np.int64)]
        total = np.zeros((len(texts), self.probability.shape[1]))
        known, typical = np.zeros(len(texts), np.int64), np.full(len(texts), -np.inf)
        for i, row in enumerate(rows):
            if row:
                at = np.array(row)
                at = at[at > 0]
                total[i] = self.scores[at].sum(axis=0)
                known[i] = len(at)
                if len(at) and total.shape[1]:
                    typical[i] = np.median(self.scores[at, total[i].argmax()] / self.sizes[at])
        return total, known, typical


_scorers: dict[str, Scorer] = {}


def held_out(column: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text leaves 1 after division by 3. False for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(rows: DataFrame, text: str, lang: str, doc_id: str, per_language: int | None) -> tuple[list[str], DataFrame]:
    """Languages in order, and ``lang``, ``text`` of all rows with both, or of about ``per_language`` of each, those of the smallest id hashes."""
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
                       F.col(f"`{doc_id}`").alias("doc_id")).where("lang is not null and text is not null")
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return [], rows.select("lang", "text")
    if per_language is None:
        return sorted(r["lang"] for r in counts), rows.select("lang", "text")
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["count"])))])
    picked = rows.where((F.xxhash64("doc_id") / F.lit(float(1 << 64)) + 0.5) < share[F.col("lang")]).select("lang", "text")
    return sorted(r["lang"] for r in counts), picked


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int | None = None,
        rounds: int = 2, smoothing: float = 0.1, vocabulary: str = VOCABULARY) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities, from rows with a language.

    All rows give their whole texts; with ``per_language`` only about so many of
    each language, those with the smallest hash of the id. Rows with a null
    text or language give nothing. Work grows with the different words.
    """
    languages, picked = _sample(rows, text, lang, doc_id, per_language)
    pieces = read_pieces(vocabulary)
    if not languages:
        return [], np.zeros((len(pieces), 0))

    def types(batches):
        for batch in batches:
            seen: dict[tuple[str, str], int] = {}
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in words.lower().split():
                    seen[name, w] = seen.get((name, w), 0) + 1
            kept = [(name, w, n) for (name, w), n in seen.items() if has_letter(w)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*kept)], names=["lang", "word", "n"])

    table = stored(picked.mapInArrow(types, "lang string, word string, n long").groupBy("lang", "word")
                   .agg(F.sum("n").alias("n"))
                   # Words of a language and length come together, so that a batch sums many at once.
                   .sortWithinPartitions("lang", F.octet_length("word")), "langid-words")
    probability = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(rounds):
        def expect(batches, now=probability):
            lattice, total = Lattice(pieces), np.zeros(now.shape)
            for batch in batches:
                names, words, n = (c.to_pylist() for c in batch.columns)
                for g, language in enumerate(languages):
                    mine = [(word_bytes(w), c) for name, w, c in zip(names, words, n) if name == language]
                    for at, matrix in _groups([w for w, _ in mine]):
                        total[:, g] += lattice.expected(matrix, np.array([mine[i][1] for i in at], float), now[:, g])
                    for word, c in mine:
                        if len(word) > PART:
                            total[:, g] += lattice.expected_long(np.frombuffer(word, np.uint8), c, now[:, g])
            piece, g = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(g), pa.array(total[piece, g])],
                                             names=["piece", "g", "uses"])

        got = (table.mapInArrow(expect, "piece long, g long, uses double").groupBy("piece", "g")
               .agg(F.sum("uses").alias("uses")).toArrow())
        uses = np.zeros(probability.shape)
        uses[got.column("piece").to_numpy(), got.column("g").to_numpy()] = got.column("uses").to_numpy()
        probability = (uses + smoothing) / (uses.sum(axis=0) + smoothing * len(pieces))
    return languages, probability


def floors(rows: DataFrame, languages: list[str], probability: np.ndarray, text: str = "text", lang: str = "lang",
           doc_id: str = "doc_id", per_language: int | None = None, lowest: float = 0.001, vocabulary: str = VOCABULARY) -> dict[str, float]:
    """For each language the least median score a byte of a text in it (see ``floors_of``).

    Taken from all texts of ``rows`` with a language; with ``per_language`` from
    the texts that a model so bounded was learned from.
    """
    _, picked = _sample(rows, text, lang, doc_id, per_language)
    scored = predict(picked, languages, probability, "text", vocabulary, "__lang", "__score", "__typical")
    return floors_of(scored, "lang", "__lang", "__typical", lowest)


def floors_of(scored: DataFrame, lang: str = "lang", predicted: str = "lang_pred", typical: str = "typical",
              lowest: float = 0.001) -> dict[str, float]:
    """The floors of rows that ``predict`` scored: those of its own language count.

    As far again below their ``lowest`` quantile as that is below their median.
    """
    marks = (scored.where(F.col(f"`{predicted}`") == F.col(f"`{lang}`")).groupBy(F.col(f"`{lang}`").alias("lang"))
             .agg(F.percentile_approx(F.col(f"`{typical}`"), F.array(F.lit(lowest), F.lit(0.5)), F.lit(10_000)).alias("q")).collect())
    return {r["lang"]: 2 * r["q"][0] - r["q"][1] for r in marks}


def predict(docs: DataFrame, languages: list[str], probability: np.ndarray, text: str = "text",
            vocabulary: str = VOCABULARY, lang_name: str = "lang_pred", score_name: str = "score",
            typical_name: str | None = None) -> DataFrame:
    """All columns of ``docs``, the predicted language and its posterior under equal priors.

    ``typical_name`` adds the median over the text's words of their log score
    a byte in that language; it is null for ``und``.

    A null text, one without a letter, or any text if no language was
    learned, is ``und`` with score 0. Ties go to the first language in order.
    """
    pieces, model = read_pieces(vocabulary), uuid.uuid4().hex
    at = docs.columns.index(text)

    def run(batches):
        scorer = _scorers.get(model)
        if scorer is None:
            _scorers.clear()
            scorer = _scorers[model] = Scorer(pieces, probability)
        for batch in batches:
            names, scores, typical = [], [], []
            column = batch.column(at)
            for k in range(0, len(column), 512):
                total, known, median = scorer.texts(column.slice(k, 512).to_pylist())
                typical.append(median)
                if languages:
                    best = total.argmax(axis=1)
                    post = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    names += [languages[b] if n else UND for b, n in zip(best, known)]
                    scores += np.where(known > 0, post, 0.0).tolist()
                else:
                    names += [UND] * len(total)
                    scores += [0.0] * len(total)
            out = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if typical_name:
                typical = np.concatenate([np.zeros(0), *typical])
                out.append(pa.array(typical, pa.float64(), mask=~np.isfinite(typical)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType()),
                           *([T.StructField(typical_name, T.DoubleType())] if typical_name else [])])
    return docs.mapInArrow(run, schema)
