import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import SF_CHECK, make_docs  # noqa: F401
from tessera.llm import langid as L

PIECES = [bytes([b]) for b in range(33, 127)] + [b" ", b" th", b"the", b"he", b" the", b"ing", b"in", b"thing"]


def slow_forward(word, probability, pieces):
    index = {p: i for i, p in enumerate(pieces)}
    alpha = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for size in range(1, end + 1):
            i = index.get(word[end - size:end])
            if i is not None:
                alpha[end] += alpha[end - size] * probability[i]
    return alpha[-1]


def all_segmentations(word, pieces):
    if not word:
        yield []
    for p in pieces:
        if word.startswith(p):
            for rest in all_segmentations(word[len(p):], pieces):
                yield [p, *rest]


@pytest.mark.parametrize("word", [b" the", b" thing", b" x", b" theinthing", b" " + b"the" * 21])
def test_forward_sums_all_segmentations(word):
    rng = np.random.default_rng(0)
    probability = rng.random((len(PIECES), 3))
    got = L.Lattice(PIECES).forward(np.frombuffer(word, np.uint8).reshape(1, -1), probability)[0]
    for g in range(3):
        assert math.isclose(got[g], math.log(slow_forward(word, probability[:, g], PIECES)), rel_tol=1e-9)
    if len(word) < 12:
        index = {p: i for i, p in enumerate(PIECES)}
        total = sum(math.prod(probability[index[p], 0] for p in s) for s in all_segmentations(word, PIECES))
        assert math.isclose(got[0], math.log(total), rel_tol=1e-9)


def test_expected_counts_are_those_of_all_segmentations():
    rng = np.random.default_rng(1)
    probability = rng.random(len(PIECES))
    index = {p: i for i, p in enumerate(PIECES)}
    word, want, total = b" thing", np.zeros(len(PIECES)), 0.0
    for s in all_segmentations(word, PIECES):
        weight = math.prod(probability[index[p]] for p in s)
        total += weight
        for p in s:
            want[index[p]] += weight
    got = L.Lattice(PIECES).expected(np.frombuffer(word, np.uint8).reshape(1, -1), np.array([3.0]), probability)
    assert np.allclose(got, 3 * want / total)


def log_sums(word, probability, pieces):
    """Log of the sum over all segmentations, by the plain recursion in logs."""
    index, longest = {p: i for i, p in enumerate(pieces)}, max(map(len, pieces))
    logs = [0.0]
    for end in range(1, len(word) + 1):
        found = [logs[end - n] + math.log(probability[index[word[end - n:end]]])
                 for n in range(1, min(longest, end) + 1) if word[end - n:end] in index]
        logs.append(max(found) + math.log(sum(math.exp(x - max(found)) for x in found)))
    return logs


@pytest.mark.parametrize("word", [b" ab" * 1 + b"the" * 30, b" " + b"ingthe" * 170, b" " + b"thinginthe" * 1000])
def test_long_words_are_summed_whole(word):
    rng = np.random.default_rng(3)
    probability = rng.random((len(PIECES), 2)) / 5
    data, lattice = np.frombuffer(word, np.uint8), L.Lattice(PIECES)
    want = [log_sums(word, probability[:, g], PIECES) for g in range(2)]
    assert np.allclose(lattice.walk(data, probability), [w[-1] for w in want], rtol=1e-10)
    assert np.allclose(lattice.walk(data, probability, keep=True), np.array(want).T, rtol=1e-9)
    assert np.allclose(lattice.walk(data, probability, back=True), [w[-1] for w in want], rtol=1e-10)
    uses = lattice.expected_long(data, 2.0, probability[:, 0])
    assert math.isclose(sum(u * len(p) for u, p in zip(uses, PIECES)), 2.0 * len(word), rel_tol=1e-9)


def test_expected_counts_of_long_words_are_those_of_short_ones():
    word, probability = np.frombuffer(b" theinthing" * 5, np.uint8), np.random.default_rng(4).random(len(PIECES))
    short = L.Lattice(PIECES).expected(word.reshape(1, -1), np.array([2.0]), probability)
    assert np.allclose(L.Lattice(PIECES).expected_long(word, 2.0, probability), short)


def test_whole_predictions_equal_the_plain_recursion(spark, make_docs):
    docs = make_docs([(1, "the fox and the hound", "en"), (2, "der fuchs und der hund", "de"), (3, "ab" * 60 + " the", None),
                      (4, "x1 " + "the" * 300, None), (5, "hund, fox 12", None)])
    languages, probability = L.fit(docs)
    pieces = L.read_pieces()
    for r in L.predict(docs, languages, probability).collect():
        total = [sum(log_sums(b" " + w.encode(), probability[:, g], pieces)[-1] for w in r.text.split() if L.has_letter(w))
                 for g in range(2)]
        assert r.lang_pred == languages[int(np.argmax(total))]
        assert math.isclose(r.score, 1 / sum(math.exp(t - max(total)) for t in total), rel_tol=1e-6)


def test_floors_part_gibberish_from_the_languages(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    languages, probability = L.fit(docs.where(~L.held_out()), per_language=100)
    floors = L.floors(docs.where(~L.held_out()), languages, probability, per_language=100)
    assert sorted(floors) == languages
    rng = random.Random(5)
    junk = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(n)) for n in (5, 20, 300)]
    out = L.predict(docs.union(spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(junk)], docs.schema)),
                    languages, probability, typical_name="typical").where("lang_pred <> 'und'").collect()
    low = [r.doc_id for r in out if r.typical < floors[r.lang_pred]]
    assert {-1, -2, -3} <= set(low) and len(low) - 3 <= 0.01 * len(out)


def test_every_text_is_learned_from_and_gives_the_floors(spark, make_docs, monkeypatch):
    import corpus_pipeline

    assert L._sample(make_docs([(i, "the fox", "en") for i in range(2500)]), "text", "lang", "doc_id", None)[1].count() == 2500
    docs = make_docs([(i, f"the quick fox number{i % 7} runs", "en") for i in range(2400)] + [(3000 + i, "der schnelle fuchs", "de") for i in range(9)])
    learned = docs.where(~L.held_out())
    seen, given = [], L.floors_of
    monkeypatch.setattr(L, "floors_of", lambda scored, *a: seen.append(scored.count()) or given(scored, *a))
    assert corpus_pipeline.language_id(spark, docs, "").count() > 2300
    assert seen == [learned.count()]
    # The default model is the one of no bound.
    whole, bounded = L.fit(learned)[1], L.fit(learned, per_language=10 ** 9)[1]
    assert np.allclose(whole, bounded) and not np.allclose(whole, L.fit(learned, per_language=200)[1], atol=1e-9)


def test_held_out_is_the_crc(spark):
    assert spark.sql("SELECT cast(null AS long) AS doc_id").select(L.held_out()).first()[0] is False
    df = spark.range(50).withColumnRenamed("id", "doc_id").withColumn("h", L.held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in df.collect())


def test_held_out_accuracy_and_blind_prediction(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    languages, probability = L.fit(docs.where(~L.held_out()), per_language=60)
    out = L.predict(docs.select("doc_id", "text", "lang"), languages, probability)
    kept = out.where(L.held_out() & F.col("text").isNotNull())
    assert kept.where("lang = lang_pred").count() >= 0.98 * kept.count()
    assert out.where("score < 0 or score > 1").count() == 0
    blind = L.predict(docs.select(F.lit(1).alias("doc_id"), "text"), languages, probability)
    assert sorted(r.lang_pred for r in blind.collect()) == sorted(r.lang_pred for r in out.collect())


def test_edges(spark, make_docs):
    docs = make_docs([(i, "the quick brown fox " * (i + 1), "en") for i in range(6)]
                     + [(i, "der schnelle braune fuchs läuft " * (i - 5), "de") for i in range(6, 12)]
                     + [(20, None, "en"), (21, "", None), (22, "123 -- ½ !!", "de"), (23, "fox", None), (23, "fox", None),
                        (None, "der fuchs", None), (24, "the fox " * 40_000, None), (25, "x" * 5_000, None)])
    languages, probability = L.fit(docs)
    assert languages == ["de", "en"] and np.allclose(probability.sum(axis=0), 1)
    out = L.predict(docs, languages, probability)
    assert out.columns == [*docs.columns, "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert got[20] == got[21] == got[22] == ("und", 0.0)
    assert got[0][0] == "en" and got[6][0] == "de" and got[24][0] == "en" and got[None][0] == "de" and got[25][0] in languages
    empty = docs.limit(0)
    assert L.fit(empty)[0] == [] and L.predict(empty, languages, probability).count() == 0
    assert {r.lang_pred for r in L.predict(docs, *L.fit(empty)).collect()} == {"und"}
