"""Preference formatting: one shared prompt and two masked completions per pair.

The chosen and the rejected conversation of a pair are compared turn by turn.
Their longest common turn prefix is rendered once, as the prompt. The turns
after it are rendered as the two completions, with the character spans that
carry loss: the assistant's words and their end mark, not the headers nor
what others say.

Only DataFrame functions are used. A pair's turns meet in one row, as the
training example that is made of them does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored
from tessera.operators.numbering import number_rows

# The turn marks of the common ChatML layout.
START, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"


def _turns(turns: DataFrame, pair_id: str, name: str) -> DataFrame:
    return (turns.where(F.col(f"`{pair_id}`").isNotNull())
            .select(F.col(f"`{pair_id}`").alias("pair_id"),
                    F.struct(*[F.col(f"`{c}`").alias(c) for c in ("turn", "role", "text")]).alias("x"))
            .groupBy("pair_id").agg(F.sort_array(F.collect_list("x")).alias(name)))


def _header(x):
    return F.concat(F.lit(START), F.coalesce(x["role"], F.lit("")), F.lit(BREAK))


def _body(x):
    return F.concat(F.coalesce(x["text"], F.lit("")), F.lit(END))


def _render(turns):
    return F.array_join(F.transform(turns, lambda x: F.concat(_header(x), _body(x))), "")


def _mask(turns, trained: str):
    """Spans ``start``, ``end`` (characters, end exclusive) of the trained role's words in the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc, x):
        begin = acc["at"] + F.length(_header(x))
        end = begin + F.length(_body(x))
        span = F.array(F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct(end.cast("int").alias("at"),
                        F.when(x["role"] == trained, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame, pair_id: str = "pair_id", trained: str = "assistant") -> DataFrame:
    """Format pairs of conversations.

    Both tables have ``pair_id``, ``turn``, ``role``, ``text``. Returns
    ``pair_id``, ``prompt_turns``, ``prompt``, ``chosen``, ``rejected``,
    ``chosen_mask``, ``rejected_mask``. Turns are ordered by number (a null
    number first, ties by role and text); two turns are equal if role and text
    are, nulls included.

    A null role or text is rendered as empty. A pair that has turns on one
    side only gives no row, nor have rows with a null pair id a pair. If one
    conversation is a prefix of the other, or equal to it, its completion is
    empty. Repeated rows are turns of their own. An empty table gives no rows.
    Other columns are not read.
    """
    both = _turns(chosen, pair_id, "c").join(_turns(rejected, pair_id, "r"), "pair_id")
    same = F.expr("""transform(sequence(1, least(size(c), size(r))),
                     i -> c[i - 1].role <=> r[i - 1].role and c[i - 1].text <=> r[i - 1].text)""")
    cut = both.withColumn("same", same).select("pair_id", "c", "r", F.expr(
        "case when array_position(same, false) > 0 then cast(array_position(same, false) as int) - 1 else size(same) end"
    ).alias("prompt_turns"))
    split = cut.select("pair_id", "prompt_turns", F.expr("slice(c, 1, prompt_turns)").alias("p"),
                       F.expr("slice(c, prompt_turns + 1, size(c))").alias("c"),
                       F.expr("slice(r, prompt_turns + 1, size(r))").alias("r"))
    return split.select("pair_id", "prompt_turns", _render(F.col("p")).alias("prompt"), _render(F.col("c")).alias("chosen"),
                        _render(F.col("r")).alias("rejected"), _mask(F.col("c"), trained).alias("chosen_mask"),
                        _mask(F.col("r"), trained).alias("rejected_mask"))


def swapped_answers(turns: DataFrame, conv_id: str = "conv_id", trained: str = "assistant") -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: chosen and rejected turns.

    The rejected conversation is the chosen one with its last answer replaced
    by the last answer of the next answered conversation in the order of ids,
    whatever their gaps; after the last one comes the first. Answered
    conversations are numbered by ranges of the id and joined on the number.

    The last answer is the text, not null, of the trained role with the
    largest turn number (null is the smallest); of answers that share that
    number it is the greatest text. Rows that repeat it are replaced with it.
    Conversations without an answer, with a null id, or whose answer equals
    the next one's (as that of a lone conversation does) make no pair. An
    empty table makes none. Other columns are not read.
    """
    rows = turns.select(F.col(f"`{conv_id}`").alias("pair_id"), "turn", "role", "text").where("pair_id is not null")
    last = (rows.where((F.col("role") == trained) & F.col("text").isNotNull()).groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("x")).select("pair_id", "x.turn", "x.text"))
    ranked = number_rows(last, ["pair_id"], "rank")
    n = max(1, ranked.count())
    swap = stored(
        ranked.select("pair_id", F.col("turn").alias("swap_turn"), F.col("text").alias("own"), ((F.col("rank") + 1) % n).alias("rank"))
        .join(ranked.select("rank", F.col("text").alias("swap_text")), "rank").where("own <> swap_text").drop("rank"), "answers")
    joined = rows.join(swap, "pair_id")
    swapped = (F.col("role") == trained) & F.col("turn").eqNullSafe(F.col("swap_turn")) & F.col("text").eqNullSafe(F.col("own"))
    return (joined.select("pair_id", "turn", "role", "text"),
            joined.select("pair_id", "turn", "role", F.when(swapped, F.col("swap_text")).otherwise(F.col("text")).alias("text")))


def mask_text(column: str):
    """Spans as text, such as ``13-40,66-90``."""
    return F.array_join(F.transform(column, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
