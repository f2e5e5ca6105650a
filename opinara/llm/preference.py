"""Preference pairs for training: common prompt once, two completions, and the characters that count for the loss.

The prompt of a pair is the longest common prefix of turns (same role, same text) of the chosen and the rejected
conversation. Turns are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``; those markers inside a text are broken up with
a space, so that a text cannot open or close a turn. A completion is what follows the prompt. Its mask lists the spans
[begin, end) of characters that are trained on: text and end marker of each assistant turn.

Cases: turns are ordered by number, then role, then text (nulls first); exact repeats of a turn (number, role and text)
count once. A null role or text renders as empty but equals only another null. A pair of which one side has no turns has an
empty prompt; two equal conversations have empty completions and ``differs`` false. Pairs with a null id are left out of
the result. Other columns are not read. One conversation is one row of the result, so its turns meet in one task; no other
group is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers of a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns_in_order(turns: DataFrame, key: str) -> DataFrame:
    """One row per conversation: ``key`` and ``turns`` (array of role and text)."""
    turn = F.struct("turn", "role", "text")
    grouped = turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    return grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))))


def _plain(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn.role), F.lit("\n"))


def _rendered(turn: Column) -> Column:
    return F.concat(_head(turn), _plain(turn.text), F.lit(CLOSE + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def loss_spans(turns: Column) -> Column:
    """[begin, end) of text and end marker of the assistant turns in ``render(turns)``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state.at + F.char_length(_head(turn))
        end = begin + F.char_length(_plain(turn.text)) + len(CLOSE)
        spans = F.when(turn.role == "assistant", F.concat(state.spans, F.array(F.array(begin, end)))).otherwise(state.spans)
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state.spans)


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns in which two arrays agree."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first_difference = F.array_position(same, False)
    return F.when(first_difference == 0, F.size(same)).otherwise(first_difference - 1).cast("int")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Pairs ready for training from two tables of turns (``key``, turn, role, text)."""
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = (
        turns_in_order(chosen, key)
        .withColumnRenamed("turns", "c")
        .join(turns_in_order(rejected, key).withColumnRenamed("turns", "r"), key, "full")
        .select(key, F.coalesce("c", empty).alias("c"), F.coalesce("r", empty).alias("r"))
        .withColumn("prompt_turns", common_prefix(F.col("c"), F.col("r")))
    )
    n = F.col("prompt_turns")

    def rest(turns: str) -> Column:
        return F.slice(turns, n + 1, F.greatest(F.size(turns) - n, F.lit(0)))

    split = sides.select(key, "prompt_turns", F.slice("c", F.lit(1), n).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return split.select(
        key, "prompt_turns", render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        loss_spans(F.col("c")).alias("chosen_mask"), loss_spans(F.col("r")).alias("rejected_mask"),
        ((F.size("c") + F.size("r")) > 0).alias("differs"),
    )
