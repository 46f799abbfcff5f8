"""Recall of repeated passages on random texts with planted, edited copies."""

import random

import numpy as np

from llm_data import make_docs  # noqa: F401
from tessera.llm import chain_dedup as C


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


def edited(rng, passage, share, mixed):
    out = []
    for w in passage:
        how = rng.randrange(3) if mixed else 0
        if rng.random() >= share:
            out.append(w)
        elif how < 2:
            out += words(rng, 1) if how == 0 else [w, *words(rng, 1)]
    return out


def alike(a, b):
    code = {w: i for i, w in enumerate({*a, *b})}
    return C.common_words(np.array([code[w] for w in a]), np.array([code[w] for w in b])) / max(len(a), len(b))


def covered(found, pairs):
    """Share of the (document, source) pairs found over most of the planted words."""
    got = {}
    for r in found.collect():
        got.setdefault((r.doc_id, r.source_id), set()).update(range(r.start, r.end))
    return np.mean([len(got.get(k, set()) & set(range(a, b))) >= 0.7 * (b - a) for k, (a, b) in pairs.items()])


def test_edited_passages_from_the_stated_similarity_up_are_found(spark, make_docs):
    rng, rows, pairs = random.Random(3), [], {}
    for size in (60, 120):
        for mixed in (False, True):
            for share in (0.0, 0.05, 0.1, 0.14, 0.18):
                for _ in range(10):
                    p = words(rng, size)
                    q = edited(rng, p, share, mixed)
                    while alike(p, q) < 0.8 or len(q) < 50:
                        q = edited(rng, p, share, mixed)
                    i = len(rows)
                    rows += [(i, words(rng, 70) + p + words(rng, 60)), (i + 1, words(rng, 40) + q + words(rng, 80))]
                    pairs[i + 1, i] = (40, 40 + len(q))
    docs = make_docs([(i, " ".join(w), "en") for i, w in rows])
    assert covered(C.repeated_passages(docs), pairs) >= 0.95


def test_alignment_is_as_long_as_the_longest_common_subsequence(monkeypatch):
    rng = np.random.default_rng(4)
    for _ in range(40):
        a, b = (rng.integers(0, 6, rng.integers(1, 30)) for _ in range(2))
        x, y = C.alignment(a, b)
        assert len(x) == C.common_words(a, b) and (a[x] == b[y]).all()
        assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
    a = rng.integers(0, 1 << 30, 900)
    b = np.delete(np.insert(a, [200, 500], 7), [50, 333, 700])
    monkeypatch.setattr(C, "ALIGNED", 100)
    x, y = C.alignment(a, b)
    assert len(x) >= 890 and (a[x] == b[y]).all() and (np.diff(x) > 0).all() and (np.diff(y) > 0).all()


def test_verbatim_passages_within_form_fields_are_found(spark, make_docs):
    rng, rows, pairs = random.Random(6), [], {}
    for n in range(40):
        size, shared = rng.choice([55, 65, 80]), rng.choice([10, 12, 14])
        fields = [words(rng, shared) for _ in range(10)]
        p, i = words(rng, size), 2 * n

        def form():
            filled = [f + words(rng, rng.choice([6, 9, 12])) for f in fields]
            return sum(filled[:5], []), sum(filled[5:], [])

        for doc in (i, i + 1):
            head, tail = form()
            rows.append((doc, head + p + tail))
            if doc > i:
                pairs[doc, i] = (len(head), len(head) + size)
    docs = make_docs([(i, " ".join(w), "en") for i, w in rows])
    found = C.repeated_passages(docs)
    assert covered(found, pairs) == 1.0
    for r in found.collect():
        assert r.end - r.start >= 50 and r.similarity >= 0.8


def test_longest_alike_against_all_pairs():
    rng = np.random.default_rng(8)
    for _ in range(200):
        x, y = (np.cumsum(rng.choice([1, 1, 1, 2, 4], 25)) for _ in range(2))
        runs = [x[j] - x[i] + 1 for i in range(25) for j in range(i, 25)
                if x[j] - x[i] + 1 >= 8 and j - i + 1 >= 0.8 * max(x[j] - x[i] + 1, y[j] - y[i] + 1) - 1e-9]
        got = C.longest_alike(x, y, 8, 0.8)
        assert (x[got[1]] - x[got[0]] + 1 if got else None) == max(runs, default=None)


def test_seeds_that_earlier_documents_hold_do_not_hide_a_passage(spark, make_docs):
    rng, rows, pairs, taken = random.Random(9), [], {}, []
    for n in range(40):
        p = words(rng, 60)
        q = edited(rng, p, 0.05 if n % 2 else 0.0, False)
        # Every seed of the passage comes in an earlier document, each by itself.
        taken += [words(rng, 12) + p[i:i + 5] + words(rng, 27) for i in range(56)]
        i = 100_000 + 2 * n
        rows += [(i, words(rng, 70) + p + words(rng, 60)), (i + 1, words(rng, 40) + q + words(rng, 80))]
        pairs[i + 1, i] = (40, 40 + len(q))
    docs = make_docs([(i, " ".join(w), "en") for i, w in [*enumerate(taken), *rows]])
    assert covered(C.repeated_passages(docs), pairs) == 1.0


def test_later_versions_are_linked_to_the_one_they_were_edited_from(spark, make_docs):
    rng = random.Random(10)
    a = words(rng, 100)
    b = [w if i % 7 else f"b{i}" for i, w in enumerate(a)]
    c = [w if i % 7 != 3 else f"c{i}" for i, w in enumerate(b)]
    assert alike(a, b) >= 0.8 and alike(b, c) >= 0.8 and alike(a, c) < 0.8
    rows = [(1, words(rng, 30) + a), (2, b + words(rng, 30)), (3, words(rng, 20) + c)]
    got = {(r.doc_id, r.source_id) for r in C.repeated_passages(make_docs([(i, " ".join(w), "en") for i, w in rows])).collect()}
    assert {(2, 1), (3, 2)} <= got


def test_links_are_the_first_and_the_preceding_occurrence(spark):
    rng = random.Random(11)
    rows = [(rng.choice([5, 5, 5, 5, -3, 8, rng.randrange(100)]), rng.randrange(300), rng.randrange(9)) for _ in range(4000)]
    found = spark.createDataFrame(rows, "hash long, doc long, pos int")
    want, by_hash = set(), {}
    for h, d, p in sorted(set(rows)):
        by_hash.setdefault(h, []).append((d, p))
    for places in by_hash.values():
        for before, mine in zip(places, places[1:]):
            want |= {(*mine, *before), (*mine, *places[0])}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 13):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert {tuple(r) for r in C.links(found).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
