"""Preference formatting: a shared prompt and two masked completions.

``format_pairs``  chosen and rejected conversations -> the longest common prefix
of turns (same role and text), rendered once as the prompt, and the rest of
either conversation as a completion with the character ranges that carry loss:
the text of an assistant turn and its end mark, never a role header, nor a turn
of the user or the system.
``all_answer_pairs``  conversations -> such pairs: a conversation up to its last
answer against the same turns with the answer of its neighbour (the
conversation whose id differs in the last bit), or of the next conversation that
has one where the neighbour has none.

A conversation's turns become one array in its row, in the order of turn, role
and text; nothing larger than a conversation is gathered.

Defined results: a null text is empty, a null role is ``user``; turns that repeat
in every column count once; a pair with a null id, or without turns on either
side, is no pair; equal conversations have the whole as prompt and two empty
completions (``tie``); an empty table gives none; other columns are ignored; a
conversation without an answer is no pair; the only one with an answer is paired
with itself (``tie``); turns after the last answer follow neither completion and
are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.session import materialize

# fixed values: the marks of a turn
HEAD, MIDDLE, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
END_MARK = len(TAIL) - 1        # the loss covers the end mark but not the line break
RANGE_ROWS = 10_000             # answers that one task puts in order


def gathered(turns: DataFrame, key: str) -> DataFrame:
    """(key, turns): the ordered array of struct<role, text> of each conversation."""
    rows = turns.where(F.col(key).isNotNull()).select(
        F.col(key).alias(key), F.struct(
            F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    return rows.groupBy(key).agg(F.transform(
        F.array_sort(F.array_distinct(F.collect_list("t"))),
        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE), t["text"], F.lit(TAIL))), "")


def loss_ranges(turns: Column) -> Column:
    """[from, to) character ranges of the rendered turns that carry loss, as
    ``from-to`` joined by commas."""
    size = F.transform(turns, lambda t: F.length(t["role"]) + F.length(t["text"]) + (len(HEAD) + len(MIDDLE) + len(TAIL)))
    def span(t: Column, i: Column) -> Column:
        start = F.aggregate(F.slice(size, 1, i), F.lit(0), lambda a, b: a + b) + len(HEAD) + F.length(t["role"]) + len(MIDDLE)
        return F.when(t["role"] == "assistant", F.concat_ws("-", start, start + F.length(t["text"]) + END_MARK))
    return F.array_join(F.array_compact(F.transform(turns, span)), ",")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs(pair_id, chosen, rejected)``, arrays as of ``gathered``, formatted."""
    rows = pairs.where("pair_id is not null and size(chosen) > 0 and size(rejected) > 0")
    shortest = F.least(F.size("chosen"), F.size("rejected"))
    same = F.transform(F.slice("chosen", 1, shortest), lambda t, i: t == F.get(F.col("rejected"), i))
    first_other = F.array_position(same, False)
    rows = rows.withColumn("n", F.when(first_other > 0, first_other - 1).otherwise(shortest).cast("int"))
    rest = lambda name: F.slice(F.col(name), F.col("n") + 1, F.size(name) + 1)      # noqa: E731
    rows = rows.withColumns({"prompt_turns": F.slice("chosen", F.lit(1), F.col("n")), "chosen_turns": rest("chosen"),
                             "rejected_turns": rest("rejected")})
    return rows.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), render(F.col("prompt_turns")).alias("prompt"),
        render(F.col("chosen_turns")).alias("chosen"), loss_ranges(F.col("chosen_turns")).alias("chosen_loss"),
        render(F.col("rejected_turns")).alias("rejected"), loss_ranges(F.col("rejected_turns")).alias("rejected_loss"),
        ((F.size("chosen_turns") == 0) & (F.size("rejected_turns") == 0)).alias("tie"))


def all_answer_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected, neighbour) of every conversation that has an
    answer.  ``neighbour``: the rejected answer is the neighbour's; if that has
    none, it is that of the next conversation with an answer, in the order of the
    MD5 of the id, the first one after the last."""
    rows = gathered(conversations.withColumn("conv_id", F.col("conv_id").cast("long")), "conv_id")
    at = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1)))
    rows = rows.withColumn("at", at).where("at is not null")
    # written once: the answers are taken from it three times
    rows = materialize(rows.select("conv_id", F.slice("turns", F.lit(1), F.col("at")).alias("turns")), "answered")
    answers = rows.select("conv_id", F.element_at("turns", -1).alias("answer"))
    other = answers.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("answer").alias("theirs"))

    # the order is cut by the MD5's first digits into ranges of about RANGE_ROWS
    digits = max(0, math.ceil(math.log(max(1, rows.count() / RANGE_ROWS), 16)))
    md5 = F.md5(F.col("conv_id").cast("string").cast("binary"))
    dealt = answers.withColumn("order", F.struct(md5.alias("md5"), "conv_id")).withColumn("range", F.substring(md5, 1, digits))
    inside = dealt.select("conv_id", "range", F.lead("answer").over(Window.partitionBy("range").orderBy("order")).alias("inside"))
    # a row a range: what follows its last conversation
    firsts = dealt.groupBy("range").agg(F.min_by("answer", "order").alias("answer"))
    order = Window.orderBy("range")
    edges = firsts.select("range", F.coalesce(
        F.lead("answer").over(order), F.first("answer").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("edge"))
    follows = inside.join(edges, "range").select("conv_id", F.coalesce("inside", "edge").alias("following"))

    return rows.join(other, "conv_id", "left").join(follows, "conv_id").select(
        F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), F.array(F.coalesce("theirs", "following"))).alias("rejected"),
        F.col("theirs").isNotNull().alias("neighbour"))
