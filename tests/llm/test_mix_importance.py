import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import SF_SMALL, make_docs  # noqa: F401
from tessera.llm import hashed, importance, soft_mix
from tessera.llm.queries import label_domains

GOOD = "the quiet river runs through green fields of tall summer grass"
BAD = "buy cheap pills now click here win cash prize offer today"


def corpus(n=40):
    return [(i, " ".join([(GOOD if i % 3 else BAD)] * (1 + i % 4)), "en") for i in range(n)]


def labels(spark, n=40):
    return spark.createDataFrame([(i, "good" if i % 3 else "bad") for i in range(0, n, 2)], "doc_id long, domain string")


def test_rates_hit_the_targets_and_match_a_dense_solver(spark, make_docs):
    docs, lab = make_docs(corpus()), labels(spark)
    out = soft_mix.mix(docs, lab, {"good": 0.5, "bad": 0.5}, scale=1.0).toPandas()
    p, n, r = np.stack(out.posterior), out.tokens.to_numpy(), out.rate.to_numpy()
    total = n.sum()
    assert np.allclose((n * r) @ p / total, [0.5, 0.5], atol=2e-4)
    assert (r >= 0).all() and (out.copies.to_numpy() >= np.floor(r)).all() and (out.copies.to_numpy() <= np.ceil(r)).all()
    # the same iteration on dense arrays
    misses, rate = [], None
    for _ in range(60):
        _, point = soft_mix.replay(p, misses, 1.0)
        gap = (n * point) @ p - np.array([0.5, 0.5]) * total
        if abs(gap).max() <= 1e-4 * total:
            break
        misses.append(gap / (n @ p))
    rate, _ = soft_mix.replay(p, misses, 1.0)
    assert np.allclose(rate, r, atol=1e-6)


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = label_domains(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    domains, table = soft_mix.posteriors(docs, labels.where("doc_id % 4 <> 0"))
    kept = table.join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    said = [domains[int(np.argmax(p))] for p in kept.posterior]
    assert np.mean(kept.domain == np.array(said)) > 0.85


def test_softmax_regression_reaches_its_optimum():
    rng = np.random.default_rng(0)
    x = np.c_[rng.random((300, 4)) < 0.4, np.ones(300)].astype(float)
    y = (x[:, 0] + x[:, 1] + rng.random(300) > 1.1).astype(int)
    w = soft_mix.fit_softmax(x, y, 2, penalty=1e-2, steps=400)
    slope = x.T @ (soft_mix.softmax(x @ w) - np.eye(2)[y]) / 300 + 1e-2 * w
    assert np.abs(slope).max() < 1e-4


def test_weight_on_one_domain_starves_the_other(spark, make_docs):
    out = soft_mix.mix(make_docs(corpus()), labels(spark), {"good": 1.0}, scale=0.5).toPandas()
    p = np.stack(out.posterior)
    assert out.rate[p[:, 0] > 0.99].max() < 0.05 and out.rate[p[:, 1] > 0.99].min() > 0.4  # bad, good


def test_mix_edges(spark, make_docs):
    docs = make_docs([(1, None, None), (2, "", None), (2, "", None), (None, GOOD, "en"), (3, BAD * 2000, "en"), (4, GOOD, "en")])
    lab = spark.createDataFrame([(3, "bad"), (4, "good"), (None, "good"), (99, "good"), (4, None), (4, "bad")],
                                "doc_id long, domain string")
    out = soft_mix.mix(docs, lab, {"good": 1, "bad": 1}).collect()
    assert len(out) == 6 and {r.tokens for r in out if r.doc_id in (1, 2)} == {0}
    plain = soft_mix.mix(docs, lab.limit(0), {"good": 1}, scale=0.5).collect()
    assert {r.rate for r in plain} == {0.5}
    assert soft_mix.mix(docs.limit(0), lab, {"good": 1}).count() == 0


def test_counts_match_a_loop(spark, make_docs):
    docs = make_docs(corpus(9)).select("doc_id", "text")
    sample = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, class int")
    got = hashed.class_counts(docs, sample, 2, 1 << 16, 2, everything=True)
    n = [len(t.split()) * 2 - 1 for _, t, _ in corpus(9)]
    assert got.sum(axis=1).tolist() == [n[0], n[1], sum(n)]


def test_bounded_sample_takes_at_most_so_many(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, 1), (None, 0), (7, None)], "doc_id long, class int")
    got = hashed.bounded_sample(rows, 10).collect()
    assert sorted(r["class"] for r in got) == [0] * 10 + [1] * 10


def test_resample_draws_the_target_like_documents(spark, make_docs):
    docs = make_docs(corpus(60))
    target = spark.createDataFrame([(i,) for i in range(60) if i % 3 and i % 2], "doc_id long")
    out = importance.resample(docs, target, share=0.5, buckets=1 << 12).toPandas()
    assert out.selected.sum() == 30 and len(out) == 60
    assert (out[out.selected].doc_id % 3 != 0).all()
    assert out[out.selected].gumbel_key.min() >= out[~out.selected].gumbel_key.max()


def test_a_target_document_is_scored_without_itself(spark, make_docs):
    rows = [(0, "alpha beta alpha", "en"), (1, "alpha beta gamma", "en"), (2, "delta delta", "en"), (3, "alpha", "en")]
    docs, target = make_docs(rows).select("doc_id", "text"), spark.createDataFrame([(0,), (1,)], "doc_id long")
    got = {r.doc_id: r.mean_log_ratio for r in importance.log_ratios(docs, target, buckets=1 << 16).collect()}
    size = 1 << 16

    def share(word, texts):
        words = " ".join(texts).split()
        return (words.count(word) + 1) / (len(words) + size)

    texts = {i: t for i, t, _ in rows}
    for i, text in texts.items():
        model = [texts[j] for j in (0, 1) if j != i]
        want = np.mean([np.log(share(w, model) / share(w, texts.values())) for w in text.split()])
        assert np.isclose(got[i], want)


def test_every_target_document_is_counted(spark, monkeypatch):
    # One word a document, 20,500 of the 20,600 targets hold "alpha": a fifth of a percent would go missing.
    docs = spark.range(20_700).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20_500, "alpha").otherwise("beta").alias("text"))
    target = docs.where("doc_id < 20600").select("doc_id")
    size = 1 << 10
    want = {"alpha": np.log((20_499 + 1) / (20_599 + size)), "beta": np.log((100 + 1) / (20_600 + size))}
    want = {w: x - np.log((n + 1) / (20_700 + size)) for (w, x), n in zip(want.items(), (20_500, 200))}
    for most in (importance.MOST_IDS, 10):
        monkeypatch.setattr(importance, "MOST_IDS", most)
        out = importance.log_ratios(docs, target, buckets=size).where("doc_id in (0, 20650)").collect()
        got = {r.doc_id: r.mean_log_ratio for r in out}
        assert np.isclose(got[0], want["alpha"]) and np.isclose(got[20650], want["beta"])


def test_the_query_weighs_pairs_of_words(spark, tmp_path):
    from tessera.llm.queries import op10_importance

    # The same words in every text: by single words alone all weights are about 0.
    texts = ["red fox runs home", "home runs fox red"]
    spark.createDataFrame([(i, texts[i % 2]) for i in range(40)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = op10_importance(spark, str(tmp_path)).toPandas()
    like, unlike = out[out.doc_id % 2 == 0].log_weight, out[out.doc_id % 2 == 1].log_weight
    assert len(out) == 40 and out.selected.sum() == 20
    assert like.min() > unlike.max() + 3


def test_resample_edges(spark, make_docs):
    docs = make_docs([(1, None, None), (2, "", None), (2, "", None), (None, GOOD, "en"), (5, GOOD * 3000, "en")])
    target = spark.createDataFrame([(5,), (None,)], "doc_id long")
    out = importance.resample(docs, target, share=0.5, buckets=1 << 10).collect()
    assert sorted(r.doc_id for r in out) == [1, 2, 2, 5]
    assert {r.log_weight for r in out if r.doc_id != 5} == {0.0}
    assert importance.resample(docs, target.limit(0), share=1.0, buckets=64).where("selected").count() == 4
    assert importance.resample(docs.limit(0), target, share=0.5, buckets=64).count() == 0


@pytest.mark.parametrize("k", [1, 7, 50, 99, 100])
def test_kth_largest(spark, k):
    values = [((i * 37) % 50) / 7 for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(2)
    assert importance.kth_largest(df, "v", k, bins=4, small=3) == sorted(values, reverse=True)[k - 1]


def test_label_domains(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert {r[0] for r in label_domains(labels).select("domain").distinct().collect()} <= {"good", "plain", "toxic"}
    assert label_domains(labels).where(F.col("domain").isNull()).count() == 0
