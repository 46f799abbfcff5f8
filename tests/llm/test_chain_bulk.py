import random

import numpy as np
import pyarrow as pa

from llm_data import make_docs  # noqa: F401
from tessera.llm import chain_dedup as C


def pieces_of_one_pair(x, y, k, max_gap):
    keep = C.thinned(x, y, k)
    x, y = x[keep], y[keep]
    for chain in C.chains(x, y, k):
        cuts = np.flatnonzero((np.diff(x[chain]) > max_gap) | (np.diff(y[chain]) > max_gap)) + 1
        for part in np.split(chain, cuts):
            if len(part) > 1:
                yield x[part[0]], x[part[-1]] + k, y[part[0]], y[part[-1]] + k


def test_pieces_of_many_pairs_are_those_of_each():
    rng = np.random.default_rng(3)
    rows, want = [], set()
    for pair in range(300):
        mine = set()
        for _ in range(rng.integers(1, 5)):
            x, y = rng.integers(0, 90, 2).tolist()
            mine |= {(x + j, y + j) for j in range(rng.integers(1, 14))}
        rows += [(pair, *m) for m in sorted(mine)]
        x, y = np.array(sorted(mine)).T
        want |= {(pair, *map(int, p)) for p in pieces_of_one_pair(x, y, 5, 25)}
    got = C.pieces(*np.array(rows).T, 5, 25)
    assert {tuple(r) for r in got.tolist()} == want and len(got) == len(want) > 300
    assert len(C.pieces(*np.zeros((3, 0), np.int64), 5, 25)) == 0


def test_bulk_test_turns_no_row_away_that_may_hold():
    rng = np.random.default_rng(9)
    pairs = [(np.zeros(0, np.int32), np.arange(60, dtype=np.int32)), (np.arange(C.ALIGNED + 1), np.arange(3))]
    for _ in range(600):
        a = rng.integers(-1 << 31, 1 << 31, rng.integers(10, 200))
        b = np.where(rng.random(len(a)) < rng.choice([0.1, 0.18, 0.25, 0.9]), rng.integers(-1 << 31, 1 << 31, len(a)), a)
        pairs.append((a, b[rng.integers(0, 10):]))
    a, b = (pa.array([p[i].tolist() for p in pairs], pa.list_(pa.int32())) for i in (0, 1))
    got = C.may_be_alike(a, b, 50, 0.8, rows=64)
    exact = np.array([C.may_hold(x, y, 50, 0.8) for x, y in pairs])
    assert got[exact].all() and exact.sum() > 100
    assert got.sum() < 1.2 * exact.sum()  # and few others reach the alignment
    assert C.may_be_alike(a.slice(5, 40), b.slice(5, 40), 50, 0.8).tolist() == got[5:45].tolist()


def test_seed_links_are_the_first_and_the_preceding_occurrence_of_cold_and_hot_seeds(spark, make_docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(25)]
    texts = {i: rng.choices(vocabulary, k=rng.randrange(60)) + ["every", "one", "line"] for i in range(400)}
    docs = make_docs([(i, " ".join(w), "en") for i, w in texts.items()]).selectExpr("doc_id AS doc", "cast(text AS binary) AS text")
    assert any(C.hot_seeds(docs, 3, 1))
    places, want = {}, set()
    for i, words in texts.items():
        for p in range(len(words) - 2):
            places.setdefault(tuple(words[p:p + 3]), []).append((i, p))
    for found in places.values():
        for before, mine in zip(found, found[1:]):
            want |= {(*mine, *before), (*mine, *found[0])}
    got = [tuple(r) for r in C.seed_links(docs, 3, 1, 2).select("doc", "pos", "src", "src_pos").collect()]
    assert set(got) == want and len(got) == len(want)
