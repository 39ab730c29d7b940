"""Preference formatting: a shared prompt and two masked completions.

A pair holds a chosen and a rejected conversation.  Their longest common prefix
of turns (equal role and text) is the prompt and is rendered once; what follows
in each is its completion.  Loss falls on the text and end mark of assistant
turns of a completion; everything else is masked.  The mask is a list of
[start, end) character spans of the completion, as text ``start-end,...``.

Prefixes are found on turn rows (a join on pair and position, and the least
position that differs), so only the finished strings are collected per pair.

Defined cases: turns are ordered by turn, then role, then text (null first), so
repeated turns and ties have one order; null role or text counts as empty; if
one conversation is the beginning of the other, its completion is empty; an
empty common prefix gives an empty prompt; a pair without one of its sides is
left out; rows of null pair are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ranked, written

# The template's marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def answered_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, turn, role, text): a pair of each conversation, whose
    rejected side has the last answer of the next conversation (by id, those with
    an answer; the last takes the first's) in place of its own last answer.  A
    conversation without an answer is its own rejected side."""
    own = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.lit(True).alias("chosen"), "turn", "role", "text")
    turns = written(_placed(own).drop("chosen"), "chat-turns")
    answers = turns.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(F.max(F.struct("at", "text")).alias("x"))
    order = ranked(answers.select(F.lit(0).alias("all"), "pair_id", "x.at", "x.text"), "all", ["pair_id"], "chat-order")
    follows = order.select(F.pmod(F.col("idx") - 1, "n").alias("idx"), F.col("text").alias("other"))
    swaps = order.join(follows, "idx").select(F.col("pair_id").alias("p"), F.col("at").alias("last"), "other")
    said = F.when(F.col("other").isNotNull(), F.col("other")).otherwise(F.col("text"))
    other = turns.join(swaps, (F.col("pair_id") == F.col("p")) & (F.col("at") == F.col("last")), "left")
    return turns.select("pair_id", F.lit(True).alias("chosen"), F.col("at").alias("turn"), "role", "text").unionByName(
        other.select("pair_id", F.lit(False).alias("chosen"), F.col("at").alias("turn"), "role", said.alias("text")))


def numbered_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen, turn, role, text) of a table that is made of pairs:
    conversation 2k is the chosen and 2k + 1 the rejected side of pair k."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(F.floor(conv / 2).cast("long").alias("pair_id"), (F.pmod(conv, F.lit(2)) == 0).alias("chosen"),
                                "turn", "role", "text")


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with their position, rendered, with the span that loss falls on."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where("pair_id is not null and chosen is not null").select("pair_id", "chosen", "turn", role.alias("role"),
                                                                            text.alias("text"))
    order = Window.partitionBy("pair_id", "chosen").orderBy("turn", "role", "text")
    return rows.select("pair_id", "chosen", F.row_number().over(order).alias("at"), "role", "text")


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair: pair_id, prompt_turns, prompt, chosen, rejected,
    chosen_mask, rejected_mask (spans with loss)."""
    rows = _placed(turns)
    # a position has two rows where both sides are that long; the prefix ends
    # before the first position with one row, or with two different ones
    at = rows.groupBy("pair_id", "at").agg(F.count(F.lit(1)).alias("sides"), F.min(F.struct("role", "text")).alias("a"),
                                           F.max(F.struct("role", "text")).alias("b"))
    differs = (F.col("sides") < 2) | (F.col("a") != F.col("b"))
    prefix = at.groupBy("pair_id").agg(F.coalesce(F.min(F.when(differs, F.col("at"))), F.max("at") + 1).alias("ends"))
    rendered = F.concat(F.lit(OPEN), "role", F.lit("\n"), "text", F.lit(CLOSE))
    head = F.length(F.concat(F.lit(OPEN), "role", F.lit("\n")))
    kept = rows.join(prefix, "pair_id").where((F.col("at") >= F.col("ends")) | F.col("chosen")).withColumn(
        "piece", F.struct("at", rendered.alias("body"), head.alias("head"), (F.col("role") == TRAINED_ROLE).alias("trained")))

    def side(chosen: bool):
        return F.array_sort(F.collect_list(F.when((F.col("at") >= F.col("ends")) & (F.col("chosen") == chosen), F.col("piece"))))

    sides = rows.groupBy("pair_id").agg(F.count_distinct("chosen").alias("sides"))
    prompt = F.array_sort(F.collect_list(F.when(F.col("at") < F.col("ends"), F.col("piece"))))
    out = kept.groupBy("pair_id", "ends").agg(prompt.alias("prompt"), side(True).alias("yes"), side(False).alias("no"))

    def string(pieces: str):
        return F.array_join(F.transform(pieces, lambda p: p["body"]), "")

    def mask(pieces: str):
        start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("spans"))
        folded = F.aggregate(pieces, start, lambda s, p: F.struct(
            (s["n"] + F.length(p["body"])).alias("n"),
            F.when(p["trained"], F.array_append(s["spans"], F.concat_ws(
                "-", s["n"] + p["head"], s["n"] + F.length(p["body"]) - 1))).otherwise(s["spans"]).alias("spans")))
        return F.array_join(folded["spans"], ",")

    both = out.join(sides.where("sides = 2").select("pair_id"), "pair_id")
    return both.select("pair_id", (F.col("ends") - 1).cast("long").alias("prompt_turns"), string("prompt").alias("prompt"),
                       string("yes").alias("chosen"), string("no").alias("rejected"), mask("yes").alias("chosen_mask"),
                       mask("no").alias("rejected_mask"))
