import random
import re
from collections import Counter

import pytest

from llm_data import SF_SMALL, make_docs  # noqa: F401
from tessera.llm import collocation as C

WORD = re.compile(r"[^\x20\x09]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def slow(rows, least, longest=5, top=2000, percent=100):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        count = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = WORD.findall(piece)
            n[lang] += len(words)
            count.update(tuple(words[i:j]) for i in range(len(words)) for j in range(i + 1, min(len(words), i + longest) + 1))
    out = []
    for lang, count in f.items():
        covered, found = set(), []
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            covered |= {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= percent * count[p[i:j]]}
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.fixture
def many_ranges(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "a", "b", "a\x01", "é", "x\x00y", "hall"]
    out = []
    for _ in range(n):
        some = rng.choices(words, [9, 8, 5, 5, 4, 3, 3, 1, 1, 1, 2], k=rng.randrange(1, 30))
        out.append("".join(w + rng.choice([" ", " ", " ", "\t", " \t ", ". ", "\n", ", "]) for w in some) + "New York City Hall")
    return out


@pytest.mark.parametrize("seed,bits,block", [(1, 1 << 15, 400), (2, 1 << 20, 1 << 20)])
def test_equals_counting_every_phrase(spark, make_docs, many_ranges, seed, bits, block):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["en", "en", "fr", None, "und"])) for i, t in enumerate(texts(seed))]
    for least, top, percent in ((5, 2000, 100), (12, 4, 100), (5, 50, 60)):
        got = C.collocations(make_docs(rows).repartition(3), least, top=top, covered_percent=percent, filter_bits=bits, text_bytes=block).collect()
        assert sorted(map(tuple, got)) == slow([(lang, t) for _, t, lang in rows], least, top=top, percent=percent)
        assert got


def test_a_hot_first_word_spans_ranges(spark, make_docs, many_ranges):
    rows = [(i, " ".join(f"the w{j}" for j in range(i % 5, 40)), "en") for i in range(60)]
    got = C.collocations(make_docs(rows).repartition(4), 10)
    assert sorted(map(tuple, got.collect())) == slow([(lang, t) for _, t, lang in rows], 10)


@pytest.mark.parametrize("longest", [2, 3])
def test_shorter_windows(spark, make_docs, longest):
    rows = [(i, t, "en") for i, t in enumerate(texts(5, 60))]
    got = C.collocations(make_docs(rows), 4, longest=longest).collect()
    assert sorted(map(tuple, got)) == slow([("en", t) for _, t, _ in rows], 4, longest)


def test_products_beyond_64_bits(spark):
    both = [("en", ["a", "b"], 10**14)]
    phrases = spark.createDataFrame([*both, ("en", ["a"], 10**14), ("en", ["b"], 3 * 10**14)], "lang string, words array<string>, f long")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    real, C.frequent_phrases = C.frequent_phrases, lambda *a, **k: (phrases, totals)
    try:
        row = C.collocations(phrases).first()
    finally:
        C.frequent_phrases = real
    assert row.score == 1000 * 10**14 * 10**15 // (3 * 10**28)


def test_empty_null_and_odd_rows(spark, make_docs):
    assert C.collocations(make_docs([])).collect() == []
    rows = [(1, None, None), (2, "", "en"), (3, " .,\n\t", "en"), (None, "one", "fr"), (4, "b a " * 30_000, "en"), (4, "b a " * 3, None)]
    got = sorted(map(tuple, C.collocations(make_docs(rows), 3).collect()))
    assert got == slow([(lang, t) for _, t, lang in rows], 3)
    assert {r[0] for r in got} == {"en", "und"}


def test_bitmap_marks_what_is_frequent(spark):
    rows = [(k, 1) for k in (5, -7, 2**62, 5 + 2**40)] + [(5, 2), (-7, 2)]
    marked = C.Marked(C.mark(spark.createDataFrame(rows, "key long, n long"), 3, 1 << 15))
    import numpy as np
    keys = np.array([5, -7, 2**62 + 1, 8], np.int64).view(np.uint64)
    assert marked(keys).tolist() == [True, True, False, False]


def test_query_over_the_table(spark):
    from tessera.llm import queries

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = queries.QUERIES["op12_collocation"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == slow([(r.lang, r.text) for r in docs], 100)


def test_counts_held_by_a_task_are_bounded_by_their_bytes():
    import pyarrow as pa

    taken = []

    def tables():
        for i in range(64):  # 1 MB each, in few rows
            taken.append(i)
            yield pa.table({"lang": ["en"] * 100, "phrase": [f"{i} {j} " + "x" * 10_000 for j in range(100)], "n": pa.array([1] * 100, pa.int64())})

    out = C._summed(tables(), ["lang", "phrase"])
    first = next(out)
    assert len(taken) * 1_000_000 < 2 * C.HELD_BYTES
    assert first.num_rows + sum(b.num_rows for b in out) == 6400
