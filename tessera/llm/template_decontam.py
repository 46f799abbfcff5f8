"""Benchmark decontamination by canonical templates.

Numbers, capitalised names and units of measure become typed placeholders, so
a question with other values has the same template; a second view takes a run
of names, and a number with its unit, as one placeholder. Windows of template
tokens are hash-joined between documents and benchmark items. Matches on one
diagonal (document position less item position), or in a chain over
neighbouring ones, in which words may be inserted or missing, are then checked
for slot consistency: equal item values must stand for equal document values and the
other way round, within each type. Windows that break the mapping do not
count. A document leaks an item if its consistent windows cover enough of the
item's windows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chain_dedup import chains
from tessera.llm.common import stored

# Units of measure and currencies, lower case.
UNITS = frozenset("""
mm cm m km in inch inches ft foot feet yd yard yards mi mile miles
mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne tonnes
ml cl l liter liters litre litres gallon gallons
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
mph kph km/h m/s hz khz mhz ghz w kw v kv a j kj n pa k c f °c °f
$ € £ usd eur gbp dollar dollars euro euros cent cents % percent
""".split())
NUMBER, QUANTITY, NAME, UNIT = "<num>", "<qty>", "<name>", "<unit>"
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d,.:/]*")
_QUANTITY = re.compile(r"[+-]?[$€£]?(\d[\d,.:/]*)([^\W\d_]+[/°%]?\w*|[%°]\w*|[$€£])")
_EDGE = "\"'`.,;:!?()[]{}<>«»„“”‘’*_|#&~"
# Windows of benchmark items that are sent to every task at most; beyond, all windows are joined by a shuffle.
SENT_WINDOWS = 2_000_000


def kind_of(token: str) -> str | None:
    """The placeholder of a token stripped of punctuation, or None for a literal word."""
    if _NUMBER.fullmatch(token):
        return NUMBER
    if (m := _QUANTITY.fullmatch(token)) and m[2].lower() in UNITS:
        return QUANTITY
    if token.lower() in UNITS and len(token) > 1 or token in "$€£%":
        return UNIT
    return NAME if token[0].isupper() else None


class Tokens(dict):
    """White-space word -> (template hash, value of its slot or None); (0, None) for bare punctuation."""

    LIMIT = 500_000

    def __missing__(self, word: str) -> tuple[int, str | None]:
        if len(self) > self.LIMIT:
            self.clear()
        token = word.strip(_EDGE)
        if not token:
            got = (0, None)
        elif kind := kind_of(token):
            got = (xxhash.xxh64_intdigest(kind) | 1, kind + token.lower())
        else:
            got = (xxhash.xxh64_intdigest(token.lower()) & ~1 or 2, None)
        self[word] = got
        return got


def template(text: str | None, tokens: Tokens) -> tuple[np.ndarray, list[str | None]]:
    """Template hashes of a text (odd: a placeholder, even: a literal) and the slots' values."""
    got = [t for t in map(tokens.__getitem__, (text or "").split()) if t[0]]
    return np.array([t[0] for t in got], np.uint64), [t[1] for t in got]


_CODE = {kind: xxhash.xxh64_intdigest(kind) | 1 for kind in (NUMBER, QUANTITY, NAME, UNIT)}


def collapsed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The template with each run of names as one name and a number and its unit as one quantity.

    Returns the codes and the tokens where they begin.
    """
    name, number, unit = (codes == np.uint64(_CODE[k]) for k in (NAME, NUMBER, UNIT))
    after = np.zeros(len(codes), bool)
    after[1:] = name[1:] & name[:-1] | unit[1:] & number[:-1]
    codes = codes.copy()
    codes[:-1][unit[1:] & number[:-1]] = _CODE[QUANTITY]
    at = np.flatnonzero(~after)
    return codes[at], at


def slots_of(values: list[str | None], bounds: list[int]) -> list[str | None]:
    """The values of the slots that begin at ``bounds`` (one more for the end)."""
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a == 1:
            out.append(values[a])
        elif values[a].startswith(NAME):
            out.append(NAME + " ".join(v[len(NAME):] for v in values[a:b]))
        else:
            out.append(QUANTITY + values[a][len(NUMBER):] + values[a + 1][len(UNIT):])
    return out


def windows(codes: np.ndarray, size: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of each window that holds at least ``literals`` literal words."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    acc, words = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for j in range(size):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + codes[j:j + n]
        acc ^= acc >> np.uint64(29)
        words += (codes[j:j + n] & np.uint64(1)) == 0
    at = np.flatnonzero(words >= literals)
    return acc[at].view(np.int64), at


def _windows(rows: DataFrame, size: int, literals: int, only: np.ndarray | None) -> DataFrame:
    """Every window, or those in ``only``, of the templates of a text: as it is (view 0) and collapsed (view 1).

    ``pos`` counts the view's tokens, ``at`` those of the text; ``total`` is
    the number of windows of the text in the view.
    """
    def run(batches):
        tokens = Tokens()
        for batch in batches:
            out = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes, values = template(text.as_py(), tokens)
                short, begin = collapsed(codes)
                for view, (codes, starts) in enumerate(((codes, None), (short, begin))):
                    hashes, at = windows(codes, size, literals)
                    hashes ^= view  # a hash of one view does not meet the other
                    total = len(at)
                    if only is not None and total:
                        i = np.searchsorted(only, hashes)
                        i[i == len(only)] = 0
                        hit = only[i] == hashes
                        hashes, at = hashes[hit], at[hit]
                    if starts is None:
                        out += [(ident, view, h, p, p, values[p:p + size], total) for h, p in zip(hashes.tolist(), at.tolist())]
                    else:
                        bounds = [*starts.tolist(), len(values)] if len(at) else []
                        out += [(ident, view, h, p, bounds[p], slots_of(values, bounds[p:p + size + 1]), total)
                                for h, p in zip(hashes.tolist(), at.tolist())]
                if len(out) > 20_000:
                    yield _window_batch(out)
                    out = []
            if out:
                yield _window_batch(out)

    return rows.mapInArrow(run, "id long, view int, hash long, pos int, at int, slots array<string>, total int")


def _window_batch(rows):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["id", "view", "hash", "pos", "at", "slots", "total"])


def consistent(pairs: list[tuple[int, list[str | None], list[str | None]]]) -> tuple[set[int], bool]:
    """Item positions of the windows whose slots keep one mapping, and whether any value differs.

    ``pairs`` has, in order of item position, the slots of matching windows.
    The first value met for a slot fixes its mapping.
    """
    there: dict[str, str] = {}
    back: dict[str, str] = {}
    good, changed = set(), False
    for pos, mine, theirs in pairs:
        slots = [(a, b) for a, b in zip(mine, theirs) if a is not None]
        if all(there.get(a, b) == b and back.get(b, a) == a for a, b in slots) and len(dict(slots)) == len(set(slots)):
            for a, b in slots:
                there[a], back[b] = b, a
                changed |= a != b
            good.add(pos)
    return good, changed


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = 5, literals: int = 2, coverage: float = 0.5,
          max_shift: int = 25, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Benchmark items found in documents.

    Returns ``doc_id``, ``item_id``, ``coverage`` (share of the item's windows
    that one diagonal, or a chain over diagonals with up to ``max_shift``
    tokens between neighbours, matches consistently), ``reworded`` (some slot has
    another value) and ``pos`` (token position in the document where the item
    begins). One row per pair with at least ``coverage``.

    Rows with a null id take no part. A null or short text has no window;
    items of fewer than ``size`` tokens, or without a window of ``literals``
    literal words, cannot be found. Repeated rows of a document or item count
    once. An empty table gives no rows. Other columns are not read.
    """
    def rows(df, ident, body):
        return df.where(F.col(f"`{ident}`").isNotNull()).select(
            F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{body}`").alias("text"))

    items = stored(_windows(rows(benchmark, item_id, item_text), size, literals, None).distinct(), "benchmark-windows")
    only = None
    if items.select("hash").distinct().limit(SENT_WINDOWS + 1).count() <= SENT_WINDOWS:
        only = np.sort(items.select("hash").distinct().toArrow().column(0).to_numpy())
    if only is not None and not len(only):
        only = np.zeros(1, np.int64)
    mine = items.select(F.col("id").alias("item"), "view", "hash", F.col("pos").alias("item_pos"),
                        F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "total")
    found = _windows(rows(docs, doc_id, text), size, literals, only).drop("total").join(mine, ["hash", "view"]).select(
        F.col("id").alias("doc"), "item", "view", "pos", "item_pos", "at", "item_at", "item_slots", "slots", "total")

    def check(batches):
        """Rows come sorted by document, item, view and position."""
        key, pairs, total = None, [], 0
        for batch in batches:
            out = []
            for doc, item, view, pos, item_pos, at, item_at, theirs, slots, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc, item, view) != key:
                    if key:
                        out += close(key, pairs, total)
                    key, pairs, total = (doc, item, view), [], n
                pairs.append((pos, item_pos, at - item_at, theirs, slots))
            if out:
                yield _leak_batch(out)
        if key and (out := close(key, pairs, total)):
            yield _leak_batch(out)

    def close(key, pairs, total):
        """The best diagonal and the best chain over neighbouring ones."""
        lines: dict[int, list] = {}
        for p in pairs:
            lines.setdefault(p[0] - p[1], []).append(p)
        ways = list(lines.values())
        if len(lines) > 1:
            x, y = (np.array(c) for c in list(zip(*pairs))[:2])
            for chain in chains(x, y, size):
                cuts = np.flatnonzero(np.abs(np.diff(x[chain] - y[chain])) > max_shift) + 1
                ways += [[pairs[i] for i in part] for part in np.split(chain, cuts)]
        out = []
        for way in ways:
            if len(way) < coverage * total:
                continue
            way.sort(key=lambda p: p[1])
            good, changed = consistent([p[1:2] + p[3:] for p in way])
            out.append((len(good) / total, not changed, -next((p[2] for p in way if p[1] in good), way[0][2])))
        return [(key[0], key[1], share, not same, -early) for share, same, early in [max(out)]] if out else []

    by = ["doc", "item", "view", "pos", "item_pos"]
    scored = found.repartition("doc", "item").sortWithinPartitions(*by).mapInArrow(
        check, "doc long, item long, coverage double, reworded boolean, pos int")
    best = scored.groupBy("doc", "item").agg(F.max(F.struct("coverage", F.expr("not reworded").alias("same"),
                                                            F.expr("-pos").alias("early"))).alias("b"))
    return best.where(F.col("b.coverage") >= coverage).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("b.coverage").alias("coverage"),
        F.expr("not b.same").alias("reworded"), F.expr("-b.early").alias("pos"))


def _leak_batch(rows):
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["doc", "item", "coverage", "reworded", "pos"])


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that leak a benchmark item; rows with a null id stay."""
    bad = stored(leaks(docs, benchmark, doc_id=doc_id, text=text, **how).select(F.col("doc_id").alias("__bad")).distinct(),
                 "leaks")
    return docs.join(bad, docs[f"`{doc_id}`"] == bad["__bad"], "left_anti")
