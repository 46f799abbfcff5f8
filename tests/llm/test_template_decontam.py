import random

import numpy as np

from llm_data import make_docs  # noqa: F401
from tessera.llm import template_decontam as D

ITEM = "Alice walks 12 km every day and Bob walks 7 km less than Alice does in 3 hours"
LEAK = "so then Carol walks 90 km every day and Dave walks 4 km less than Carol does in 8 hours they said"
BROKEN = "so then Carol walks 90 km every day and Dave walks 90 km less than Erin does in 90 hours they said"


def test_kinds():
    kinds = {w: D.kind_of(w) for w in ["12", "3,000.5", "$5", "5kg", "km", "Paris", "walks", "a5", "%", "m"]}
    assert kinds == {"12": D.NUMBER, "3,000.5": D.NUMBER, "$5": D.NUMBER, "5kg": D.QUANTITY, "km": D.UNIT, "Paris": D.NAME,
                     "walks": None, "a5": None, "%": D.UNIT, "m": None}


def test_slots_must_map_one_to_one():
    good, changed = D.consistent([(0, ["<num>1", None], ["<num>5", None]), (1, [None, "<num>1"], [None, "<num>5"]),
                                  (2, ["<num>2", None], ["<num>5", None]), (3, ["<num>1", None], ["<num>6", None])])
    assert good == {0, 1} and changed


def test_verbatim_and_reworded_leaks_are_found(spark, make_docs):
    benchmark = spark.createDataFrame([(7, ITEM), (8, "the quick brown fox jumps over the lazy dog tonight"), (7, ITEM),
                                       (9, None), (10, "too short"), (None, ITEM)], "item_id long, text string")
    docs = make_docs([(1, "before " + ITEM + " after", "en"), (2, LEAK, "en"), (3, BROKEN, "en"), (4, None, None), (5, "", "en"),
                      (6, "nothing here at all to be seen by anyone", "en"), (None, ITEM, "en"), (1, "before " + ITEM + " after", "en"),
                      (11, "pad " * 30_000 + ITEM, "en"), (12, "12 13 14 15 16 17 18 19 20 21 22", "en")])
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 7), (2, 7), (11, 7)}
    assert got[1, 7].coverage == 1.0 and not got[1, 7].reworded and got[1, 7].pos == 1
    assert got[2, 7].reworded and got[2, 7].coverage > 0.8
    kept = D.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [12, 3, 4, 5, 6, None]
    assert D.leaks(docs.limit(0), benchmark).count() == 0 and D.leaks(docs, benchmark.limit(0)).count() == 0


def test_shuffled_path_gives_the_same(spark, make_docs, monkeypatch):
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    docs = make_docs([(1, ITEM, "en"), (2, LEAK, "en"), (3, "other words " * 20, "en")])
    sent = sorted(map(tuple, D.leaks(docs, benchmark).collect()))
    monkeypatch.setattr(D, "SENT_WINDOWS", 0)
    assert sorted(map(tuple, D.leaks(docs, benchmark).collect())) == sent and len(sent) == 2


def test_windows_against_a_loop():
    tokens = D.Tokens()
    codes, values = D.template("In 5 days , Ann saw 7 of them", tokens)
    assert len(codes) == 8 and values[1] == "<num>5"
    hashes, at = D.windows(codes, 4, 2)
    want = [i for i in range(5) if sum(int(c) % 2 == 0 for c in codes[i:i + 4]) >= 2]
    assert at.tolist() == want and len(np.unique(hashes)) == len(hashes)


def test_leaks_with_longer_slots_and_inserted_or_missing_words_are_found(spark, make_docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    items, docs = [], []
    for n in range(60):
        words = [word() for _ in range(38)]
        for i in range(4, 38, 9):
            words[i] = f"Town{n}{'abcdefg'[i // 9]}"
        items.append((n, " ".join(words)))
        other = [w.replace("Town", "New Port") if w.startswith("Town") else w for w in words]
        for at in sorted(rng.sample(range(1, 37), 1 + n % 3), reverse=True):
            other[at:at + 1] = [other[at], word()] if rng.random() < 0.5 else [] if other[at].islower() else [other[at]]
        docs.append((n, " ".join([word() for _ in range(20)] + other + [word() for _ in range(20)]), "en"))
    benchmark = spark.createDataFrame([*items, (100, "Ann drove 5 km to the old mill and then 7 km back home")],
                                      "item_id long, text string")
    docs.append((100, "we heard that Mary Ann drove 5km to the old mill and then 9km back home today", "en"))
    docs.append((101, "nothing of the kind was ever said about mills or homes that were old", "en"))
    got = {(r.doc_id, r.item_id) for r in D.leaks(make_docs(docs), benchmark).collect()}
    assert got == {(n, n) for n in [*range(60), 100]}


def test_collapsed_template():
    codes, values = D.template("We saw New York City after 5 km , 5km from Rome", D.Tokens())
    short, at = D.collapsed(codes)
    assert D.slots_of(values, [*at.tolist(), len(values)]) == [
        "<name>we", None, "<name>new york city", None, "<qty>5km", "<qty>5km", None, "<name>rome"]
    assert short[4] == short[5] and short[2] == short[7]


def test_a_pair_with_too_few_windows_gives_no_row(spark, make_docs):
    benchmark = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert D.leaks(make_docs([(1, "he knows that Carol walks 90 km every day", "en")]), benchmark).count() == 0
