"""Preference formatting of conversations.

A pair is a chosen and a rejected conversation. The longest common prefix of their turns is rendered once, as the
prompt; what follows in each is a completion, with the character spans a loss may count: the text of assistant turns
and the mark that ends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rendering of a turn: head with the role, text, end.
HEAD, ROLE_END, END = "<|im_start|>", "\n", "<|im_end|>\n"
ASSISTANT = "assistant"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation in order, ``array<struct<turn, role, text>>``.

    A null role or text is empty. Turns of the same number are ordered by role and text, and identical rows are one turn.
    Null numbers come first. Rows without a conversation id are left out: they belong to none.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return turns.where(F.col(conv_id).isNotNull()).groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_set(one)).alias("turns"))


def pair_by_opening(whole: DataFrame, together: int = 100_000) -> DataFrame:
    """Pairs of conversations that open alike: ``(chosen, rejected)`` ids, every conversation in one pair at most.

    Conversations with the same first turn are dealt out by a hash of their id into sub-groups, ordered there by falling
    number of turns and rising id, and paired with their neighbours; the longer one, or at a tie the one of smaller
    id, is chosen. What a sub-group leaves over is paired the same way with what the others leave, so of each opening one
    conversation at most stays alone. An opening has as many sub-groups as put some ``together`` conversations into each,
    so a sub-group stays small however common its opening is; the second step meets one row of each.
    """
    opening = F.xxhash64(F.col("turns")[0]["role"], F.col("turns")[0]["text"])
    rows = whole.where(F.size("turns") > 0).select("conv_id", F.size("turns").alias("n"), opening.alias("opening"), F.sha2(F.concat_ws("\x00", F.col("turns")[0]["role"], F.col("turns")[0]["text"]), 256).alias("sure"))
    common = rows.groupBy("opening", "sure").agg(F.count("*").alias("m")).where(F.col("m") > together)
    rows = rows.join(common, ["opening", "sure"], "left").withColumn(
        "part", F.pmod(F.xxhash64("conv_id"), F.coalesce(F.ceil(F.col("m") / together), F.lit(1)))).drop("m")

    def paired(df: DataFrame, keys: list[str]) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("n"), "conv_id")
        return df.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("conv_id").over(order))

    first = paired(rows, ["opening", "sure", "part"])
    rest = paired(first.where("place % 2 = 1 AND next IS NULL").select("conv_id", "n", "opening", "sure"), ["opening", "sure"])
    both = [p.where("place % 2 = 1 AND next IS NOT NULL").select(F.col("conv_id").alias("chosen"), F.col("next").alias("rejected")) for p in (first, rest)]
    return both[0].unionByName(both[1])


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), turn["role"], F.lit(ROLE_END), turn["text"], F.lit(END))


def _spans(turns: Column, begin: Column) -> Column:
    """Character ranges ``(start, stop)`` of assistant texts and their end marks in the rendering of ``turns``, from ``begin`` on."""
    size = F.transform(turns, lambda t: F.length(_rendered(t)))
    starts = F.transform(size, lambda _, i: begin + F.aggregate(F.slice(size, 1, i), F.lit(0), lambda a, x: a + x))
    placed = F.arrays_zip(turns.alias("t"), starts.alias("s"), size.alias("n"))
    own = F.filter(placed, lambda p: p["t"]["role"] == ASSISTANT)
    return F.transform(own, lambda p: F.struct(
        (p["s"] + len(HEAD) + F.length(p["t"]["role"]) + len(ROLE_END)).alias("start"), (p["s"] + p["n"] - (len(END) - len(END.rstrip()))).alias("stop")))


def reply_swaps(whole: DataFrame) -> DataFrame:
    """Pairs from single conversations: ``(chosen_id, rejected_id, a, b)``, one for each conversation with an assistant turn.

    Chosen is the conversation up to its last assistant turn. Rejected is the same with another reply in that place: the
    first assistant text of the conversation that differs from it, or an empty one.
    """
    places = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i)), lambda i: i.isNotNull())
    cut = whole.withColumn("last", F.array_max(places)).where("last IS NOT NULL").withColumn("a", F.slice("turns", 1, F.col("last") + 1))
    right = F.get("a", F.col("last"))["text"]
    other = F.filter("a", lambda t: (t["role"] == ASSISTANT) & (t["text"] != right))
    wrong = F.coalesce(F.get(other, F.lit(0))["text"], F.lit(""))
    swapped = F.transform("a", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(i == F.col("last"), wrong).otherwise(t["text"]).alias("text")))
    return cut.select(F.col("conv_id").alias("chosen_id"), F.col("conv_id").alias("rejected_id"), "a", swapped.alias("b"))


def named_pairs(whole: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(chosen_id, rejected_id, a, b)`` for pairs of ids ``(chosen, rejected)``; pairs with a missing conversation are left out."""
    a = whole.select(F.col("conv_id").alias("chosen"), F.col("turns").alias("a"))
    b = whole.select(F.col("conv_id").alias("rejected"), F.col("turns").alias("b"))
    return pairs.select("chosen", "rejected").join(a, "chosen").join(b, "rejected").select(
        F.col("chosen").alias("chosen_id"), F.col("rejected").alias("rejected_id"), "a", "b")


def preference_examples(pairs: DataFrame) -> DataFrame:
    """One row per row of ``pairs`` (``chosen_id, rejected_id, a, b`` with the turns of both): ``chosen_id, rejected_id,
    common_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    Masks are spans in the completion they belong to. Equal conversations have empty completions. Turns are
    compared by role and text, not by number. An empty table gives no rows.
    """
    same = F.zip_with("a", "b", lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    first_other = F.array_position(same, False).cast("int")
    common = F.when(first_other > 0, first_other - 1).otherwise(F.size(same))
    cut = pairs.withColumn("common_turns", common)
    rest = {k: F.slice(k, F.col("common_turns") + 1, F.size(k)) for k in ("a", "b")}
    cut = cut.select("chosen_id", "rejected_id", "common_turns",
                     _render(F.slice("a", 1, F.col("common_turns"))).alias("prompt"), rest["a"].alias("a"), rest["b"].alias("b"))
    return cut.select("chosen_id", "rejected_id", "common_turns", "prompt", _render(F.col("a")).alias("chosen"), _render(F.col("b")).alias("rejected"),
                      _spans(F.col("a"), F.lit(0)).alias("chosen_mask"), _spans(F.col("b"), F.lit(0)).alias("rejected_mask"))
