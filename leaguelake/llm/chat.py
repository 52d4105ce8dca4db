"""Preference formatting: the shared beginning of two conversations as prompt, the rest as completions.

Two conversations of a pair, chosen and rejected, are compared turn by turn. The longest common prefix of
turns is rendered once; what follows in either is rendered as its completion, and of that only the text of
the assistant and the mark that ends it count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The marks of a widely used public chat format.
BEGIN, END = "<|im_start|>", "<|im_end|>"
SIDES = ("chosen", "rejected")


def _opening() -> Column:
    return F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"))


def _body() -> Column:
    return F.concat(F.coalesce("text", F.lit("")), F.lit(END + "\n"))


def preference_turns(turns: DataFrame) -> DataFrame:
    """pair_id, side, place, part (prompt or completion), role, rendered, trained_from of every turn.

    turns: pair_id, side (chosen or rejected), turn, role, text. Turns are ordered by turn, of equal ones by role
    and text, nulls first; null roles and texts render as empty and equal each other. trained_from is the
    code point of `rendered` from which it counts for the loss, null where nothing does.
    """
    order = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    placed = turns.select("pair_id", "side", "turn", "role", "text").withColumn("place", F.row_number().over(order))
    same = F.struct("role", "text")
    sides = placed.groupBy("pair_id", "place").agg(
        F.count("*").alias("there"), F.min(same).alias("one"), F.max(same).alias("other")
    )
    differs = (F.col("there") < 2) | ~F.col("one").eqNullSafe(F.col("other"))
    prefix = sides.where(differs).groupBy("pair_id").agg(F.min("place").alias("first"))
    joined = placed.join(prefix.withColumnRenamed("pair_id", "_pair"), F.col("pair_id").eqNullSafe(F.col("_pair")), "left")
    part = F.when(F.col("first").isNull() | (F.col("place") < F.col("first")), "prompt").otherwise("completion")
    trained = F.when((part == "completion") & (F.col("role") == "assistant"), F.char_length(_opening()))
    return joined.select(
        "pair_id", "side", "place", part.alias("part"), "role",
        F.concat(_opening(), _body()).alias("rendered"), trained.alias("trained_from"),
    )


def preference_records(turns: DataFrame) -> DataFrame:
    """One row for each pair: pair_id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans.

    Spans (start, end) are the code points of a completion that count for the loss. A pair with one side only has
    an empty prompt and an empty other completion; two equal conversations are all prompt. A record is built
    in memory, as every text is; what is gathered for it is one pair's turns.
    """
    rows = preference_turns(turns)
    # The prompt is taken from the chosen side; both sides hold the same one.
    used = rows.where((F.col("part") == "completion") | (F.col("side") == "chosen"))
    name = F.when(F.col("part") == "prompt", "prompt").otherwise(F.col("side"))
    line = F.struct("place", "rendered", "trained_from")

    def gathered(part: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("name") == part, line))).alias(part)

    parts = used.withColumn("name", name).groupBy("pair_id").agg(*map(gathered, ("prompt", *SIDES)))

    def text(part: str) -> Column:
        return F.array_join(F.transform(part, lambda t: t["rendered"]), "")

    def spans(part: str) -> Column:
        """Adds up lengths from turn to turn; the line end after the end mark does not count."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("found"))

        def step(state: Column, turn: Column) -> Column:
            end = state["at"] + F.char_length(turn["rendered"])
            span = F.struct((state["at"] + turn["trained_from"]).alias("start"), (end - 1).alias("end"))
            more = F.when(turn["trained_from"].isNotNull(), F.concat(state["found"], F.array(span))).otherwise(state["found"])
            return F.struct(end.alias("at"), more.alias("found"))

        return F.aggregate(part, start, step, lambda state: state["found"])

    return parts.select(
        "pair_id", F.size("prompt").alias("prompt_turns"), text("prompt").alias("prompt"),
        *[text(side).alias(side) for side in SIDES], *[spans(side).alias(f"{side}_spans") for side in SIDES],
    )


def reply_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of preference pairs made of a table of conversations (conv_id, turn, role, text).

    Chosen: the conversation up to its last reply of the assistant. Rejected: the same, that reply being replaced by
    the assistant's reply before, or, where there is none, by the text of the turn before it. Rows alike in all four
    columns count once; other rows that share a number are turns of their own, ordered by role and text, nulls first,
    as in preference_turns, and the last reply is the last in that order. Conversations
    without a reply, or with nothing before their only reply, give no pair, nor do rows with a null conv_id or turn.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null and turn is not null").distinct()
    place = F.struct("turn", "role", "text")  # compared field by field, nulls lowest, as preference_turns orders
    replies = rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max(place).alias("last"))
    before = rows.join(replies, "conv_id").where(place < F.col("last")).groupBy("conv_id", "last").agg(
        F.max(F.when(F.col("role") == "assistant", place)).alias("reply"), F.max(place).alias("any")
    )
    other = F.when(F.col("reply").isNotNull(), F.col("reply.text")).otherwise(F.col("any.text"))
    used = rows.join(before.select("conv_id", "last", other.alias("other")), "conv_id").where(place <= F.col("last"))
    replaced = F.when(place == F.col("last"), F.col("other")).otherwise(F.col("text"))
    both = F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said")),
        F.struct(F.lit("rejected").alias("side"), replaced.alias("said")),
    )).alias("s")
    return used.select(F.col("conv_id").alias("pair_id"), "turn", "role", both).select(
        "pair_id", F.col("s.side").alias("side"), "turn", "role", F.col("s.said").alias("text")
    )
