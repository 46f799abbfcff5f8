import hashlib
import random
import re
import zlib

import pytest

from llm_data import SF_SMALL
from tessera.llm import turn_trie as T

SCHEMA = "conv_id long, turn int, role string, text string, depth string, words int, conv int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            content = (role or "", text or "")
            tie = hashlib.sha256(f"{len(content[0])}:{content[0]}{content[1]}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, content))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def slow(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {k: dict(n=len(m), children=0, leaves=0, saved=0) for k, m in members.items()}
    for k in nodes:
        if k:
            nodes[k[:-1]]["children"] += 1
    for k, v in nodes.items():
        saves = (v["n"] - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0)
        for d in range(len(k) + 1):
            nodes[k[:d]]["leaves"] += not v["children"]
            nodes[k[:d]]["saved"] += saves
    out = []
    for k, v in nodes.items():
        ends = ",".join(str(c) for c in sorted(members[k]) if len(convs[c]) == len(k))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, v["n"], v["children"], v["leaves"], v["saved"],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def conversations(seed, n=120, longest=9):
    rng = random.Random(seed)
    texts = ["hello there", "", None, "a b c", "x", "one word two"]
    rows = []
    for c in rng.sample(range(-60, 3 * n), n):
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment,shard", [(64, 4096), (2, 16), (3, 1)])
def test_equals_a_trie_of_tuples(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(T, "HOT", 3)
    rows = conversations(segment)
    assert got(T.crossed_trie(table(spark, rows).repartition(3), segment=segment, shard=shard)) == slow(rows)


def test_copies_deep_and_turnless(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400, 20) for t in range(40)]  # copies of one deep path
    rows += [(c, 1, "user", "short") for c in range(401, 419)]  # most keep nothing of their own; base 400 is absent
    rows += [(1001, None, None, None), (1001, None, "user", "x"), (1001, 0, "user", "x"), (1001, 0, "user", "x"), (None, 1, "user", "lost")]
    df = T.crossed_trie(table(spark, rows), segment=8, shard=32)
    assert got(df) == slow(rows)
    assert df.where("depth = 0").count() == 1


def test_long_conversations_meet_their_row_in_chunks(spark):
    rows = conversations(7, 50)
    turns = T.turn_rows(table(spark, rows))
    assert sorted(map(str, T.crossed(turns, chunk=2).collect())) == sorted(map(str, T.crossed(turns).collect()))


def test_only_turnless_and_empty(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert got(T.crossed_trie(table(spark, [(c, 1, "user", "gone")]))) == slow([(c, 1, "user", "gone")])
    assert got(T.crossed_trie(table(spark, []))) == []
    with pytest.raises(TypeError):
        T.turn_rows(spark.createDataFrame([("a", 1, "b", "c")], "conv_id string, turn int, role string, text string"))


def test_query_over_the_table(spark):
    from tessera.llm import queries

    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    df = queries.QUERIES["op13_turn_trie"](spark, SF_SMALL)
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got(df) == slow([tuple(r) for r in rows])
