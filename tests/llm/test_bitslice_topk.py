import math

import numpy as np
import pytest

from tessera.llm import bitslice_topk as B


def slow_top(ids, values, query_id, query, k):
    score = [(-int(v @ query), int(i)) for i, v in zip(ids, values) if i != query_id]
    return [(i, -s) for s, i in sorted(score)[:k]]


@pytest.mark.parametrize("rows,dims,spread", [(1, 3, 5), (5, 4, 300), (64, 8, 1), (200, 16, 130), (130, 2, 1 << 30)])
def test_block_equals_sorting_all_scores(rows, dims, spread):
    rng = np.random.default_rng(rows)
    values = rng.integers(-spread, spread + 1, (rows, dims))
    values[rows // 2:] = values[rows // 2]  # many equal rows: ties at the boundary
    ids = rng.permutation(rows * 2)[:rows]
    block = B.Block.build(ids, values)
    for q in [*values[:4], np.zeros(dims, np.int64)]:
        for k in (1, 5, rows + 3):
            got_ids, got = block.top(int(ids[0]), q, k)
            assert sorted(zip(got_ids.tolist(), got.tolist()), key=lambda x: (-x[1], x[0])) == slow_top(ids, values, ids[0], q, k)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [-1.0, 0.25]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 0.0]),
            (7, []), (50, [0.1, 0.2, 0.3]), (None, [1.0, 1.0]), (2, [-1.0, 0.25]), (0, [1.0, 0.5])]
    vectors = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, B.top_k(vectors, vectors.where("vec_id in (0, 3, 50)"), k=5, block_rows=4, query_rows=1).collect()))
    same, other = 256 * 256 + 128 * 128, -256 * 256 + 128 * 64
    assert got == [(0, 1, 1, same), (0, 2, 2, other), (0, 3, 2, other)]
    assert B.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_wide_components_are_scored_exactly_and_scores_beyond_a_long_are_left_out(spark):
    rows = [(0, [9e6, 1.0]), (1, [9e6, 0.5]), (2, [1.0, 0.0]), (3, [-3e12, 1.0]), (4, [1e308, 0.0]), (5, [-1e308, 2.0]),
            (6, [0.0, 1.7e308]), (7, [0.0, 2.0 ** 60]), (50, [0.0, 0.25]), (51, []), (52, []), (53, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {i: [int(x) * 256 if abs(x) >= 2 ** 53 else math.floor(x * 256) for x in v] for i, v in rows}
    want = []
    for q in exact:
        found = sorted((-s, i) for i, v in exact.items() if i != q and len(v) == len(exact[q])
                       for s in [sum(a * b for a, b in zip(v, exact[q]))] if -2 ** 63 <= s < 2 ** 63)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:5])]
    for block in (1 << 16, 2):
        assert sorted(map(tuple, B.top_k(vectors, vectors, k=5, block_rows=block).collect())) == sorted(want)
    assert [w for w in want if w[0] == 51] == [(51, 1, 52, 0)]


def test_bound_of_slices():
    values = np.arange(200)[:, None]
    block = B.Block.build(np.arange(200), values)
    slices, base = block.scores(np.array([1]))
    for bound in (-1, 0, 3, 64, 127, 198, 199, 1 << 20):
        assert B._rows(block.above(slices, bound - base)).tolist() == [i for i in range(200) if i > bound]
