import itertools
import random

import numpy as np

from llm_data import make_docs, small_docs  # noqa: F401
from tessera.llm import chain_dedup as C
from tessera.llm import common

RNG = random.Random(5)


def words(n):
    return ["".join(RNG.choices("abcdefghijklmnop", k=6)) for _ in range(n)]


def edited(passage, every):
    return [f"x{i}" if i % every == every - 1 else w for i, w in enumerate(passage)]


def test_common_words_is_the_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(0, 14)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert C.common_words(a, b) == table[-1, -1]


def test_chain_score_is_the_best_over_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(60):
        x, y = rng.integers(0, 30, 12), rng.integers(0, 30, 12)
        best = [0.0] * 12
        for j in sorted(range(12), key=lambda j: x[j]):
            before = [best[i] - C.GAP_COST * (x[j] - x[i] + y[j] - y[i]) for i in range(12) if x[i] < x[j] and y[i] < y[j]]
            best[j] = 5 + max([0.0, *before])
        chains = C.chains(x, y, 5)
        assert sorted(np.concatenate(chains).tolist()) == list(range(12))
        for c in chains:
            assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
        first = chains[0]
        score = 5 * len(first) - C.GAP_COST * (x[first[-1]] - x[first[0]] + y[first[-1]] - y[first[0]])
        assert abs(score - max(best)) < 1e-9


def test_minimizers_cover_every_window():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 50, 300).astype(np.uint64)
    rows = np.repeat([0, 1, 2, 5], [3, 150, 10, 137])
    picked = set(C.minimizers(hashes, rows, 10).tolist())
    for r in np.unique(rows):
        at = np.flatnonzero(rows == r)
        for k in range(max(1, len(at) - 9)):
            run = at[k:k + 10]
            assert {i for i in run.tolist() if hashes[i] == hashes[run].min()} <= picked


def test_passages(spark, make_docs):
    shared, fuzzy, short = words(80), words(120), words(30)
    rows = [(1, words(40) + shared + words(30)), (2, words(10) + shared + words(50)), (3, words(25) + edited(fuzzy, 14)),
            (4, edited(fuzzy, 17) + words(60)), (5, words(60) + short), (6, short + words(60)), (7, words(300)),
            (9, words(9) + shared), (9, words(9) + shared), (10, shared[:20] + words(70) + shared[20:45])]
    docs = make_docs([(i, " ".join(w), "en") for i, w in rows] + [(11, None, None), (12, "", None), (None, " ".join(shared), "en"),
                                                                  (13, "tiny", "en")])
    out = C.repeated_passages(docs)
    got = {(r.doc_id, r.source_id): r for r in out.collect()}
    assert set(got) == {(2, 1), (4, 3), (9, 1)}
    assert (got[2, 1].start, got[2, 1].end, got[2, 1].source_start, got[2, 1].similarity) == (10, 90, 40, 1.0)
    assert got[4, 3].end - got[4, 3].start >= 100 and 0.8 <= got[4, 3].similarity < 1.0
    cut = C.cut_passages(docs, out)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    texts = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    assert texts[2].split() == rows[1][1][:10] + rows[1][1][90:]
    assert texts[1] == " ".join(rows[0][1]) and texts[11] is None and texts[7] == " ".join(rows[6][1])
    assert C.repeated_passages(docs.limit(0)).count() == 0


def test_exact_repeats_in_the_table_are_covered(spark, small_docs):
    """Also those within a document, where they do not overlap."""
    found = {}
    for r in C.repeated_passages(small_docs).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    first, size, within, held = {}, 60, 0, 0
    for r in small_docs.select("doc_id", "text").orderBy("doc_id").collect():
        w = (r.text or "").encode().lower().split()
        for p in range(len(w) - size + 1):
            key = tuple(w[p:p + size])
            doc, at = first.setdefault(key, (r.doc_id, p))
            covered = len(found.get(r.doc_id, set()) & set(range(p, p + size))) >= 0.7 * size
            if doc != r.doc_id:
                assert covered, (r.doc_id, p)
            elif at + size <= p:
                within, held = within + 1, held + covered
    assert held >= 0.9 * within, (held, within)


def test_repeats_within_a_text(spark, make_docs):
    texts = {}
    for i, gap in enumerate([0, 1, 20, 60, 100, 200, 20, 60]):
        shared = words(60)
        texts[i] = words(30) + shared + words(gap) + (shared if i < 6 else edited(shared, 12)) + words(30)
    texts[20], texts[21] = words(7) * 200, words(200)
    docs = make_docs([(i, " ".join(w), "en") for i, w in texts.items()])
    got = {}
    for r in C.repeated_passages(docs).collect():
        assert r.doc_id == r.source_id and r.source_end <= r.start
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got) == [0, 1, 2, 3, 4, 5, 6, 7, 20]
    for i, gap in enumerate([0, 1, 20, 60, 100, 200]):
        r = max(got[i], key=lambda r: r.end - r.start)
        assert r.start <= 90 + gap + 3 and r.end >= 147 + gap and r.source_start <= 33 and r.similarity >= 0.8
    covered = {w for r in got[20] for w in range(r.start, r.end)}
    assert len(covered) >= 700 and min(covered) >= 50


def test_may_hold_turns_no_passage_away():
    rng = np.random.default_rng(9)
    kept = 0
    for n in range(200):
        a = rng.integers(0, 60, rng.integers(30, 200))
        b = np.where(rng.random(len(a)) < rng.choice([0.1, 0.18, 0.25, 0.9]), rng.integers(0, 60, len(a)), a)[rng.integers(0, 20):]
        if C.stretches(a, b, 50, 0.8):
            assert C.may_hold(a, b, 50, 0.8)
            kept += 1
    assert kept > 20 and not C.may_hold(np.arange(100), np.r_[np.arange(30), np.arange(200, 290)], 50, 0.8)


def test_shuffle_files_go_and_the_setting_stays(spark):
    before = spark.conf.get(common.CLEANUP)
    df = common.stored(spark.range(100).repartition(3), "kept", release=True)
    assert df.count() == 100 and spark.conf.get(common.CLEANUP) == before


def test_without_words_keeps_the_rest_as_it_is():
    text = "  a\tbé  c\n\nd e "
    assert C.without_words(text, [(1, 3)]) == "  a\td e "
    assert C.without_words(text, [(0, 99)]) == "  "
    assert C.without_words("", [(0, 1)]) == ""
