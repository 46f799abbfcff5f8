from llm_data import SF_SMALL
from tessera.llm import chat_prefix as C

TURNS = "pair_id long, turn long, role string, text string, chosen string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], TURNS)


def test_prefix_is_rendered_once_and_masks_cover_the_answers(spark):
    shared = [(1, 0, "system", "S"), (1, 1, "user", "hé")]
    chosen = table(spark, shared + [(1, 2, "assistant", "yes"), (1, 3, "user", "ok"), (1, 4, "assistant", "bye")])
    rejected = table(spark, shared + [(1, 2, "assistant", "no")])
    row = C.preference_pairs(chosen, rejected).first()
    assert row.prompt_turns == 2
    assert row.prompt == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nhé<|im_end|>\n"
    assert [row.chosen[s.start:s.end] for s in row.chosen_mask] == ["yes<|im_end|>\n", "bye<|im_end|>\n"]
    assert [row.rejected[s.start:s.end] for s in row.rejected_mask] == ["no<|im_end|>\n"]
    assert "user\nok" in row.chosen


def test_edges(spark):
    chosen = table(spark, [(1, 0, "user", None), (2, 0, "user", "a"), (3, 0, "user", "same"), (None, 0, "user", "x"),
                           (4, None, "user", "first"), (4, 1, None, ""), (5, 0, "user", "only chosen"),
                           (6, 0, "user", "r"), (6, 0, "user", "r")])
    rejected = table(spark, [(1, 0, "user", None), (1, 1, "assistant", "more"), (2, 0, "user", "b"), (3, 0, "user", "same"),
                             (None, 0, "user", "x"), (4, None, "user", "first"), (4, 1, None, "z"), (6, 0, "user", "r")])
    got = {r.pair_id: r for r in C.preference_pairs(chosen, rejected).collect()}
    assert sorted(got) == [1, 2, 3, 4, 6]
    assert got[1].prompt_turns == 1 and got[1].chosen == "" and got[1].chosen_mask == []  # one side is a prefix
    assert got[2].prompt_turns == 0 and got[2].prompt == ""
    assert got[3].prompt_turns == 1 and got[3].rejected == ""
    assert got[4].prompt_turns == 1 and got[4].rejected == "<|im_start|>\nz<|im_end|>\n"
    assert got[6].prompt_turns == 1 and got[6].chosen.count("user") == 1  # a repeated row is a turn
    assert C.preference_pairs(chosen.limit(0), rejected).count() == 0


def test_swapped_answers_make_pairs_that_differ_in_the_last_answer(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (5, 0, "user", "q2"), (5, 1, "assistant", "a2"),
                                   (6, 0, "user", "no answer"), (7, 0, "assistant", None), (None, 0, "assistant", "x"),
                                   (9, 0, "assistant", "a3"), (9, 1, "assistant", "a4"), (9, 1, "assistant", "a4"),
                                   (9, 2, "assistant", None), (40, None, "assistant", "a4"), (41, None, "assistant", "b"),
                                   (41, None, "assistant", "a")],
                                  "conv_id long, turn long, role string, text string")
    row = {r.pair_id: r for r in C.preference_pairs(*C.swapped_answers(turns)).collect()}
    text = {i: (r.prompt_turns, *("".join(t.split("<|im_start|>assistant\n")).replace("<|im_end|>\n", " ") for t in (r.chosen, r.rejected)))
            for i, r in row.items()}
    # 9 and 40 have equal last answers, so 9 makes no pair; after 41 comes 1.
    assert text == {1: (1, "a1 ", "a2 "), 5: (1, "a2 ", "a4 "), 40: (0, "a4 ", "b "), 41: (1, "b ", "a1 ")}
    lone = turns.where("conv_id in (1, 6)")
    assert C.preference_pairs(*C.swapped_answers(lone)).count() == 0
    assert C.preference_pairs(*C.swapped_answers(turns.limit(0))).count() == 0


def test_gaps_between_ids_lose_no_pair(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    gaps = turns.withColumn("conv_id", turns["conv_id"] * 7 - 3)
    a, b = (sorted(tuple(r)[1:] for r in C.preference_pairs(*C.swapped_answers(t)).collect()) for t in (turns, gaps))
    answered = turns.where("role = 'assistant' and text is not null and conv_id is not null").select("conv_id").distinct().count()
    assert str(a) == str(b) and 0.9 * answered <= len(a) <= answered
