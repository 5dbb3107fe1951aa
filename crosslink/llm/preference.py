"""Preference formatting: a chosen and a rejected conversation become one prompt and two masked completions.

The longest common prefix of their turns is the prompt, rendered once. Pairs come from a table that has both sides
(``format_pairs``), or from plain conversations, where the rejected side is the conversation with another one's last answer
(``format_exchanged``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written.
OPEN, BREAK, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def conversations(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """pair_id, is_chosen, turns: each conversation as one row, its turns in order of turn, role and text (nulls first)."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), pair.alias("pair_id"), chosen.alias("is_chosen"), turn.alias("__turn")).filter("conv_id is not null")
    grouped = rows.groupBy("conv_id", "pair_id", "is_chosen").agg(F.sort_array(F.collect_list("__turn")).alias("turns"))
    return grouped.select("pair_id", "is_chosen", "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(BREAK), t["text"], F.lit(CLOSE))), "")


def trained_spans(turns: Column) -> Column:
    """Where the model is trained in the rendered turns: "from-to" character places of what an assistant turn says, joined by commas.

    The closing mark is learned, the header is not.
    """
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))
    fixed = len(OPEN) + len(BREAK)

    def step(acc, t):
        begin = acc["at"] + fixed + F.length(t["role"])
        end = begin + F.length(t["text"]) + len(CLOSE)
        span = F.concat_ws("-", begin.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, state, step, lambda acc: acc["spans"]), ",")


def format_sides(sides: DataFrame) -> DataFrame:
    """pair_id and the turns c (chosen) and r (rejected), arrays of role and text or null -> the columns of ``format_pairs``."""
    same = F.zip_with("c", "r", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first = F.array_position(same, False)
    shared = F.coalesce(F.when(first == 0, F.size(same)).otherwise(first - 1), F.lit(0)).cast("int")
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    cut = sides.withColumn("n", shared).select("pair_id", "n", F.slice(F.coalesce("c", "r"), 1, F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    texts = [render(F.col(c)).alias(name) for c, name in (("p", "prompt"), ("c", "chosen"), ("r", "rejected"))]
    return cut.select("pair_id", F.col("n").cast("long").alias("shared_turns"), *texts, trained_spans(F.col("c")).alias("chosen_mask"), trained_spans(F.col("r")).alias("rejected_mask"))


def format_pairs(turns: DataFrame, pair: Column | None = None, chosen: Column | None = None) -> DataFrame:
    """pair_id, shared_turns, prompt, chosen, rejected, chosen_mask, rejected_mask; one row for each pair.

    ``pair``: the pair of a turn's conversation, ``chosen``: whether that is the preferred one; by default conversations 2 n
    and 2 n + 1 are pair n, the even one chosen. The longest common prefix of turns (role and text alike) is rendered once as
    prompt; what follows on either side is its completion, with the spans in it that are trained. A pair without one of its
    sides has no common turn and null for that side. Null roles and texts count as empty; turns of the same number are ordered
    by role and text; rows without conv_id are left out; several chosen or rejected conversations of a pair are paired by
    order of conv_id. Other columns are left out. An empty table gives no rows.
    """
    pair = F.shiftright(F.col("conv_id").cast("long"), 1) if pair is None else pair
    chosen = (F.col("conv_id").cast("long").bitwiseAND(F.lit(1)) == 0) if chosen is None else chosen
    whole = conversations(turns, pair, chosen)
    both = whole.groupBy("pair_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("is_chosen") == side, F.struct("conv_id", "turns")))).alias(n) for side, n in ((True, "c"), (False, "r"))])
    both = both.select("pair_id", F.explode(F.arrays_zip("c", "r")).alias("side"))
    return format_sides(both.select("pair_id", F.col("side.c.turns").alias("c"), F.col("side.r.turns").alias("r")))


def format_exchanged(turns: DataFrame) -> DataFrame:
    """The columns of ``format_pairs``, one row for each conversation; pair_id is its conv_id.

    Chosen: the conversation. Rejected: the same with what its last assistant turn says exchanged for what the last assistant turn of
    conversation conv_id xor 1 says (empty, if that is missing or has none). So the turns before it are shared and become the
    prompt. A conversation without assistant turn has equal sides: all of it is prompt, and both completions are empty. Nulls,
    turns of the same number, rows without conv_id and other columns: as in ``format_pairs``.
    """
    whole = conversations(turns, F.col("conv_id").cast("long"), F.lit(True)).select("conv_id", "turns")
    back = F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), "assistant")
    own = whole.withColumn("last", F.when(back > 0, F.size("turns") - back).cast("int"))
    other = own.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.get("turns", F.col("last"))["text"].alias("answer"))
    changed = F.transform("turns", lambda t, i: F.when(i == F.col("last"), F.struct(t["role"].alias("role"), F.coalesce("answer", F.lit("")).alias("text"))).otherwise(t))
    return format_sides(own.join(other, "conv_id", "left").select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("c"), changed.alias("r")))
