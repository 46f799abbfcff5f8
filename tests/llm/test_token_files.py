import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_data import SF_SMALL, make_docs  # noqa: F401
from tessera.llm import token_files as F
from tessera.session import scratch_path

MODEL = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(MODEL)
END = 1
ENCODER = F.Encoder(TOKENIZER, END)


def slow(rows):
    """Start, length and checksum of every row, in order of ids (null first)."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = TOKENIZER.encode(t or "", add_special_tokens=False).ids + [END]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(autouse=True)
def many_parts(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def read(parts, **how):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in F.read_documents(parts, **how).orderBy("position").collect()]


@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aZ.,;:!?-I'stmre \n", max_size=60), st.text(alphabet="aZé'st<|endofx>ΣΣς \t\n\x0b\x1c̈ 　가1½", max_size=60)),
                max_size=6))
@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
def test_words_encode_as_whole_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() if t else t for t in texts]
    want = [TOKENIZER.encode(t or "", add_special_tokens=False).ids + [END] for t in texts]
    for how in ((True, True), (True, False), (False, False)):
        ids, lengths = ENCODER.encode(pa.array(texts, pa.string()), *how)
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(F, "CACHED", 5)
    encoder = F.Encoder(TOKENIZER, END)
    for text in ["a b c", "d e f g h i j", "a z", "a " * 50]:
        assert encoder.encode(pa.array([text]), True)[0].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids + [END]
        assert len(encoder.number) <= 9


def test_special_tokens_in_a_text():
    text = "a<|endoftext|>b <|startoftext|> c"
    for by_words in (True, False):
        assert ENCODER.encode(pa.array([text]), by_words)[0].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids + [END]


@pytest.mark.parametrize("how", [(True, True), (False, False)])
def test_files_hold_the_documents_in_order(spark, make_docs, how):
    rows = [(i, f"document {i} " + "word " * (i % 7), "en") for i in range(40, -20, -1)]
    rows += [(100, None, None), (101, "", None), (102, "very long " * 20_000, "en"), (None, "no id é", "en")]
    docs = make_docs(rows).repartition(5)
    parts = F.write_token_files(docs, scratch_path(spark, "token-test"), MODEL, END, *how)
    assert parts.count() > 1
    assert read(parts) == read(parts, slice_docs=3) == slow([(i, t) for i, t, _ in rows])


def test_repeated_ids_stay(spark, make_docs):
    rows = [(7, "same", "en")] * 30 + [(7, "other text", "en"), (None, "x", "en"), (None, "x y", "en"), (9, "z", "en")]
    got = read(F.write_token_files(make_docs(rows).repartition(3), scratch_path(spark, "token-test"), MODEL, END))
    want = slow([(i, t) for i, t, _ in rows])
    assert sorted((str(i), n, c) for i, _, n, c in got) == sorted((str(i), n, c) for i, _, n, c in want)
    assert [s for _, s, _, _ in got] == np.concatenate([[0], np.cumsum([n for _, _, n, _ in got])[:-1]]).tolist()
    assert [i for i, _, _, _ in got] == [None] * 2 + [7] * 31 + [9]


def test_a_part_is_three_flat_files(spark, make_docs, tmp_path):
    rows = [(3, "three little words", "en"), (1, "one", "en"), (None, "none", "en")]
    row = F.write_token_files(make_docs(rows).coalesce(1), f"file://{tmp_path}/set", MODEL, END).orderBy("part").first()
    part = F.TokenPart(**row.asDict())
    first = TOKENIZER.encode("none", add_special_tokens=False).ids + [END]
    assert part.document(0).tolist() == first and isinstance(part.document(0), np.memmap)
    assert part.doc_ids(0, 1).tolist() == [None] and part.kind == "<u2"
    assert np.fromfile(f"{row.path.removeprefix('file://')}.offsets", "<u8")[:2].tolist() == [0, len(first)]
    assert np.fromfile(f"{row.path.removeprefix('file://')}.ids", "<u2")[:len(first)].tolist() == first


def test_bases_are_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(F, "SUPER", 3)
    rows = [(f"p{i}", i, 2, i + 1, 0, 10 * i) for i in range(11)]
    got = sorted(F.with_bases(spark.createDataFrame(rows, F.PARTS)).collect(), key=lambda r: r.part)
    assert [(r.base_ids, r.base_docs) for r in got] == [(sum(10 * j for j in range(i)), sum(j + 1 for j in range(i))) for i in range(11)]


def test_empty_and_refused(spark, make_docs):
    assert read(F.write_token_files(make_docs([]), scratch_path(spark, "token-test"), MODEL, END)) == []
    with pytest.raises(TypeError):
        F.write_token_files(spark.createDataFrame([("a", "b")], "doc_id string, text string"), "/nowhere", MODEL, END)


def test_query_over_the_table(spark):
    from tessera.llm import queries

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op11_token_files"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(slow([(r.doc_id, r.text) for r in docs]))
