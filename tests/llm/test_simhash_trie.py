import numpy as np
import pytest
import xxhash

from llm_data import make_docs, small_docs  # noqa: F401
from tessera.llm import simhash_trie as S


def slow_fingerprint(text, size=3):
    """The definition, one bit at a time."""
    words = bytes(text.encode()).lower().split()
    n = max(1, len(words) - size + 1)
    shingles = [b" ".join(words[i:i + size]) for i in range(n)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", ["", " \n\t", "One", "one two", "a b c", "a b c d a b c d", "ÉA é\x0b\x0cz y X", "w " * 50_000,
                                  " ".join(f"w{i % 7}{i}" for i in range(40_000))])
def test_fingerprint_is_the_definition(text):
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def pairs(values, bits):
    d = np.bitwise_count(values[:, None] ^ values[None, :])
    return {(int(i), int(j)) for i, j in zip(*np.where(d <= bits)) if i < j}


@pytest.mark.parametrize("leaf,width", [(1, 8), (64, 1 << 17)])
def test_trie_join_finds_exactly_the_close_pairs(leaf, width):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 20, dtype=np.uint64)
    near = [base ^ sum((np.uint64(1) << rng.integers(0, 63, 20).astype(np.uint64)) for _ in range(k)) for k in (1, 2, 3, 4)]
    values = np.unique(np.concatenate([base, *near, np.array([0, 1, 2 ** 64 - 1], np.uint64)]))
    found = [(int(min(i, j)), int(max(i, j))) for a, b in S.trie_links(values, None, 3, leaf, width) for i, j in zip(a, b)]
    assert {x for x in found if x[0] != x[1]} == pairs(values, 3)
    left, right = values[::2], values[1::2]
    both = {(int(i), int(j)) for a, b in S.trie_links(left, right, 3, leaf, width) for i, j in zip(a, b)}
    assert both == {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if int(x ^ y).bit_count() <= 3}


def test_links_keep_the_classes_when_subtrees_are_cut(spark):
    rng = np.random.default_rng(2)
    center = rng.integers(0, 2 ** 63, 6, dtype=np.uint64)
    values = np.unique(np.concatenate([center] + [center ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 60, 3)]))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = S.fingerprint_links(df, 3, subtree=8, least_depth=2).collect()
    signed = {int(v): i for i, v in enumerate(values.view(np.int64))}
    forest = S.Forest(len(values))
    forest.add(np.array([signed[r.u] for r in links]), np.array([signed[r.v] for r in links]))
    want = S.Forest(len(values))
    want.add(*map(np.array, zip(*pairs(values, 3))))
    assert (forest.label[:, None] == forest.label).tolist() == (want.label[:, None] == want.label).tolist()


BASE = " ".join(f"word{i}" for i in range(400))


def test_components_and_edges(spark, make_docs):
    near = BASE.replace("word200 ", "other ")
    docs = make_docs([(5, BASE, "en"), (3, near, "en"), (9, BASE, "en"), (9, BASE, "en"), (20, None, None), (21, " ", None),
                      (30, "short text", "en"), (31, "Short  TEXT", "en"), (None, BASE, "en"), (40, "long " * 100_000, "en")])
    out = S.simhash_components(docs).collect()
    assert len(out) == 10
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[5] == by[3] == by[9] == by[None] == {3}
    assert by[20] == by[21] == {20} and by[30] == by[31] == {30} and by[40] == {40}
    assert {r.fp for r in out if r.doc_id in (20, 21)} == {0}
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 20, 30, 40]
    only_null = make_docs([(None, "a b c d", "en"), (None, "a b c d", "en")])
    assert {r.component_id for r in S.simhash_components(only_null).collect()} == {None}
    assert S.keep_one(only_null).count() == 1
    assert S.simhash_components(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, small_docs):
    rows = small_docs.select("doc_id", "text").collect()
    prints = np.array([slow_fingerprint(r.text or "") for r in rows], np.uint64)
    forest = S.Forest(len(rows))
    forest.add(*map(np.array, zip(*(pairs(prints, 3) or {(0, 0)}))))
    least = {}
    for r, c in zip(rows, forest.label):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = {(r.doc_id, f"{int(p):016x}", least[c]) for r, p, c in zip(rows, prints, forest.label)}
    out = S.simhash_components(small_docs)
    assert {tuple(r) for r in out.select("doc_id", S.hex_fingerprint("fp"), "component_id").collect()} == want


def test_a_kept_text_reaches_the_task_once(spark):
    from conftest import plan_text

    docs = spark.createDataFrame([(1, "a b c d"), (2, None), (3, "É a")], "doc_id long, text string")
    both = S.with_fingerprint(docs, keep=["doc_id", "text"])
    assert "binary" not in plan_text(both, "simple")
    got = {r.doc_id: (r.text, r.fp % (1 << 64)) for r in both.collect()}
    assert got == {i: (t, slow_fingerprint(t or "")) for i, t in ((1, "a b c d"), (2, None), (3, "É a"))}
