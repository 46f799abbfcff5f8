"""Word hashing against a per-word loop; components against union-find."""

import random

import numpy as np
import pyarrow as pa

from tessera.llm import common
from tessera.llm.components import component_roots


def test_words_and_hashes_follow_the_text():
    texts = ["a Bb  a\tbb", "", None, "é É\x0bz", " x ", "long" * 400_000 + " a"]
    raw, offsets = common.column_bytes(pa.array(texts))
    starts, ends, rows = common.word_spans(raw, offsets)
    words = [raw[s:e].tobytes().lower() for s, e in zip(starts, ends)]
    assert words == [w for t in texts for w in (t or "").encode().lower().split()]
    assert [texts[r] for r in rows] == [t for t in texts for _ in (t or "").split()]
    hashes = common.word_hashes(raw, starts, ends)
    by = {}
    for w, h in zip(words, hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_slices_and_shingles_stay_in_their_rows():
    texts = ["a b c d", None, "a b", "b c d e"]
    got = []
    for at, raw, offsets in common.row_slices(pa.array(texts), limit=8):
        starts, ends, rows = common.word_spans(raw, offsets)
        hashes, first = common.shingle_hashes(common.word_hashes(raw, starts, ends), rows, 3)
        got += [(at + rows[f], h) for f, h in zip(first, hashes.tolist())]
    assert [r for r, _ in got] == [0, 0, 3, 3]
    assert got[1][1] == got[2][1] and len({h for _, h in got}) == 3


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(500, i) for i in range(501, 560)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    got = {r.vertex: r.root for r in component_roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    touched = {x for u, v in edges if u is not None and u != v for x in (u, v)}
    assert got == {x: root(x) for x in touched if root(x) != x}
    assert component_roots(spark.createDataFrame([], "u long, v long")).count() == 0


def test_mix_is_a_bijection_on_samples():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(common.mix(x))) == len(x)
