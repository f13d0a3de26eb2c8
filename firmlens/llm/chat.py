"""Training rows for preference tuning from pairs of conversations.

Only DataFrame functions: a conversation is an array of turns, and everything about a pair
is worked out within its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role string, text string>>"
ANSWERS = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(key, turns)``: each conversation's turns in order, as ``array<struct<role, text>>``.

    Rows that are equal in all four columns count once; turns of one number stand by role
    and text. Null roles and texts are empty strings, a null number comes first. Rows
    without a key belong to no conversation and are left out. Other columns are not read.
    """
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    gathered = turns.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sort_array(F.collect_set(one)).alias("turns"))
    return gathered.select(key, F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))


def last_answer(turns: Column) -> Column:
    """The number (from 1) of the last assistant turn; 0 if there is none."""
    numbers = F.transform(turns, lambda t, i: F.when(t.role == ANSWERS, i + 1).otherwise(0))
    return F.coalesce(F.array_max(numbers), F.lit(0))


def common_turns(one: Column, other: Column) -> Column:
    """How many turns both begin with."""
    equal = F.zip_with(one, other, lambda a, b: F.coalesce((a.role == b.role) & (a.text == b.text), F.lit(False)))
    differs = F.array_position(equal, False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(equal)).cast("int")


def head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn.role, F.lit("\n"))


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), turn.text, F.lit(CLOSE + "\n"))


def learned(turns: Column) -> Column:
    """Ranges ``start:end`` of characters of the rendered turns that a model learns from:
    texts of assistant turns with their closing mark. The rest is masked."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        begin, end = done.at + F.length(head(turn)), done.at + F.length(rendered(turn))
        span = F.concat_ws(":", begin, end - 1)
        spans = F.when(turn.role == ANSWERS, F.concat(done.spans, F.array(span))).otherwise(done.spans)
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, start, step, lambda done: done.spans), ",")


def preference_rows(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with two arrays of turns become rows for training: the other columns, and
    ``n_prompt_turns``, ``prompt``, ``chosen``, ``chosen_learned``, ``rejected``, ``rejected_learned``.

    The turns that both begin with are rendered once, as the prompt; what follows is each
    side's completion, with the ranges to learn from (offsets in the completion's
    characters). A null array is one without turns. Equal conversations have empty
    completions. Other columns of these names are replaced.
    """
    new = ["n_prompt_turns", "prompt", "chosen_learned", "rejected_learned"]
    rest = [c for c in pairs.columns if c not in (chosen, rejected, "chosen", "rejected", *new)]
    sides = {"chosen": F.coalesce(F.col(chosen).cast(TURNS), F.array().cast(TURNS)), "rejected": F.coalesce(F.col(rejected).cast(TURNS), F.array().cast(TURNS))}
    own = pairs.select(*rest, *[c.alias(f"_{n}") for n, c in sides.items()])
    own = own.withColumn("n_prompt_turns", common_turns(F.col("_chosen"), F.col("_rejected")))

    def after(side: str) -> Column:
        return F.slice(side, F.col("n_prompt_turns") + 1, F.greatest(F.size(side) - F.col("n_prompt_turns"), F.lit(0)))

    def text(turns: Column) -> Column:
        return F.array_join(F.transform(turns, rendered), "")

    return own.select(
        *rest, "n_prompt_turns", text(F.slice("_chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
        text(after("_chosen")).alias("chosen"), learned(after("_chosen")).alias("chosen_learned"),
        text(after("_rejected")).alias("rejected"), learned(after("_rejected")).alias("rejected_learned"),
    )


def answer_pairs(talks: DataFrame, partner: Column, key: str = "conv_id") -> DataFrame:
    """``(key, chosen, rejected)``: each conversation up to its last answer, and the same with
    the last answer of the conversation ``partner`` (an expression of ``key``) in its place.

    Without an own or a partner's answer that side has none; what follows the last answer
    waits for one and is left out.
    """
    own = talks.select(key, "turns", last_answer(F.col("turns")).alias("n"), partner.alias("partner"))
    answers = talks.select(F.col(key).alias("partner"), F.col("turns").alias("t"), last_answer(F.col("turns")).alias("m")).filter("m > 0")
    answers = answers.select("partner", F.slice("t", F.col("m"), 1).alias("other"))
    before = F.when(F.col("n") > 0, F.slice("turns", F.lit(1), F.greatest(F.col("n") - 1, F.lit(0)))).otherwise(F.col("turns"))
    return own.join(answers, "partner", "left").select(
        key,
        F.when(F.col("n") > 0, F.slice("turns", F.lit(1), F.col("n"))).otherwise(F.col("turns")).alias("chosen"),
        F.concat(before, F.coalesce("other", F.array().cast(TURNS))).alias("rejected"),
    )
