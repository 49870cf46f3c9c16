"""Preference formatting: a chosen and a rejected conversation become one prompt and two completions.

The longest common prefix of turns (same role and text) is rendered once as the prompt. What is left
of either side is its completion, with the spans that training may learn from: the text of assistant
turns and the mark that ends them. Positions count code points of the completion, end exclusive.

Defined results. A null text is empty, a null role is ``unknown``; turns are ordered by turn, role
and text, nulls first, so repeated turn numbers have one order. Equal conversations give an empty
completion on both sides. A conversation without turns is an empty list. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.llm.store import let, own

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURN = "struct<role:string,text:string>"
SPANS = "array<struct<start:int,end:int>>"


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: turns, an array of (role, text) in order."""
    row = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = own(turns, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    ordered = plain.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: pair_id, chosen, rejected.

    Chosen is the conversation. Rejected has its last assistant turn, and what follows, replaced by
    the last assistant turn of the conversation with the next id (an empty one if there is none);
    a conversation without an assistant turn gets that turn appended.
    """
    mine = conversations(turns)
    roles = F.transform("turns", lambda t: t["role"])
    behind = F.array_position(F.reverse(roles), F.lit("assistant"))
    before = F.when(behind > 0, F.size("turns") - behind).otherwise(F.size("turns")).cast("int")
    other = mine.select(
        (F.col("conv_id") - 1).alias("conv_id"),
        F.get(F.filter(F.reverse(F.col("turns")), lambda t: t["role"] == "assistant"), F.lit(0))["text"].alias("reply"),
    )
    reply = F.struct(F.lit("assistant").alias("role"), F.coalesce("reply", F.lit("")).alias("text"))
    rejected = F.concat(F.slice(F.col("turns"), F.lit(1), F.col("before")), F.array(reply))
    return (
        mine.withColumn("before", before)
        .join(other, "conv_id", "left")
        .select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
    )


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    return let(same, lambda s: F.when(F.array_contains(s, False), F.array_position(s, F.lit(False)) - 1).otherwise(F.size(s))).cast("int")


def _head(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE + "\n"))), "")


def learnt(turns: Column) -> Column:
    """Spans of the rendered turns that carry loss."""

    def step(s: Column, t: Column) -> Column:
        begin = s["at"] + F.length(_head(t))
        end = begin + F.length(t["text"]) + len(CLOSE)
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == "assistant", F.array_append(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans")), step, lambda s: s["spans"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans."""
    none = F.array().cast(f"array<{TURN}>")
    sides = own(pairs, "pair_id", "chosen", "rejected").select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    split = sides.withColumn("n", common_turns(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(F.col(side), F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    parted = split.select("pair_id", "n", F.slice(F.col("c"), F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return parted.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
        learnt(F.col("c")).alias("chosen_spans"), learnt(F.col("r")).alias("rejected_spans"),
    )
