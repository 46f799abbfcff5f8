"""Registered queries over the small tables, and the pipeline stage by stage."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from llm_data import SF_SMALL, make_docs, small_docs  # noqa: F401
from tessera.llm import langid, queries, simhash_trie, template_decontam

NAMES = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))


def test_one_query_an_operator():
    assert [int(n[2:].split("_")[0]) for n in NAMES] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    res = con.execute(queries.SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, res.fetchall()))


@pytest.mark.parametrize("name", ["op3_soft_mix", "op4_langid", "op5_separator_scan", "op10_importance"])
def test_one_row_a_document(spark, small_docs, name):
    ids = [r.doc_id for r in queries.QUERIES[name](spark, SF_SMALL).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in small_docs.select("doc_id").collect())


def test_stages_against_their_operators(spark, small_docs):
    docs, before = small_docs, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, SF_SMALL), name)
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema == small_docs.schema
        if name == "language_id":
            assert all(langid.has_letter(r.text) for r in docs.collect())
        if name == "simhash_near_dedup":
            classes = simhash_trie.simhash_components(before).collect()
            assert sorted(ids) == sorted({r.component_id for r in classes})
        if name == "substring_dedup":
            texts = {r.doc_id: r.text for r in before.collect()}
            assert all(len(r.text) <= len(texts[r.doc_id]) and r.n_chars == len(r.text) for r in docs.collect())
        if name == "benchmark_decontamination":
            benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            assert template_decontam.leaks(docs, benchmark).count() == 0
            assert len(ids) == before.count() - template_decontam.leaks(before, benchmark).select("doc_id").distinct().count()
        if name == "source_mixing":
            assert docs.columns[-2:] == ["rate", "copies"] and docs.where("copies < 1").count() == 0


def test_stages_take_empty_and_odd_rows(spark, make_docs):
    odd = make_docs([(1, None, None), (2, "", None), (None, "a few words of english text", "en"), (3, "a few words of english text", "en"),
                     (3, "a few words of english text", "en"), (4, "long text " * 50_000, "en")])
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF_SMALL), name)
        assert {r.doc_id for r in docs.collect()} <= {3, 4, None}
