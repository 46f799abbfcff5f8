import numpy as np
import pyarrow.fs as pafs
import pytest

from llm_data import make_docs  # noqa: F401
from tessera.llm import separator_scan as S
from tessera.session import scratch_path

END = 9


def slow_scan(tokens):
    out, start = [], 0
    for i, t in enumerate(tokens):
        if t == END:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(tokens) - start, False)] if start < len(tokens) else [])


@pytest.mark.parametrize("width,block,group", [(2, 8, 2), (4, 16, 3), (2, 1 << 20, 1024)])
def test_scan_equals_a_loop_over_the_tokens(spark, tmp_path, monkeypatch, width, block, group):
    monkeypatch.setattr(S, "SUPER", group)
    rng = np.random.default_rng(width)
    streams = {"a": [9, 9, 1, 2, 9], "b": [1] * 40 + [9] + [2] * 3, "c": [1, 2, 3], "d": rng.choice([1, 2, 9], 60, p=[.5, .3, .2]).tolist(),
               "e": [], "f": [9], "g": [2304, 9, 9 << 8] if width == 2 else [9 << 16, 9]}
    files = []
    for name, tokens in streams.items():
        data = np.array(tokens, f"<u{width}").tobytes() + (b"\x09" if name == "a" else b"")
        (tmp_path / name).write_bytes(data)
        files.append((str(tmp_path / name), len(data)))
    df = spark.createDataFrame(files, "path string, bytes long")
    got = {}
    for r in S.scan_documents(df, block, END, width).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.number, r.start, r.tokens, r.closed))
    assert {k: sorted(v) for k, v in got.items()} == {k: slow_scan(t) for k, t in streams.items() if t}


def test_counts_equal_the_tokeniser(spark, make_docs):
    rows = [(1, "Hello wide world, <|endoftext|> is text", "en"), (2, None, None), (3, "", None), (3, "", None), (None, "no id é", "en"),
            (4, "very long " * 20_000, "en")]
    docs = make_docs(rows).repartition(2)
    encode = S.encoding().encode_ordinary
    want = sorted((str(i), len(encode(t or ""))) for i, t, _ in rows)
    for block in (1 << 14, 1 << 22):
        got = S.document_tokens(docs, scratch_path(spark, "tok"), block_bytes=block).collect()
        assert sorted((str(r.doc_id), r.tokens) for r in got) == want
    assert S.document_tokens(docs.limit(0), scratch_path(spark, "tok")).count() == 0


def test_files_are_flat_and_unindexed(spark, make_docs):
    docs = make_docs([(1, "one two", "en"), (2, "three", "en")]).coalesce(1)
    row = S.write_tokens(docs, scratch_path(spark, "tok")).first()
    fs, name = S.open_fs(row.path)
    assert isinstance(fs, pafs.LocalFileSystem)
    with fs.open_input_file(name) as file:
        tokens = np.frombuffer(file.read(), "<u2").tolist()
    encode = S.encoding().encode_ordinary
    assert tokens == encode("one two") + [S.END] + encode("three") + [S.END]
