"""Preference pairs as one prompt and two masked completions, in DataFrame expressions only.

Two conversations (arrays of role and text) share their longest common prefix of equal
turns.  It is rendered once as the prompt; what is left of each is rendered as its
completion, with the character ranges a loss may use: the text and the closing mark of each
assistant turn.  All other characters are masked.

Conversations that are equal throughout leave two empty completions.  A conversation that is
a prefix of the other leaves one.

Defined cases.  Null role or text: compared as null (null equals null), rendered as empty.
A null or empty conversation has no turns.  Turns with equal number are ordered by role and
text, nulls first; rows that repeat a turn exactly count once; turns without a number come
first; turns without a conversation are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
END = "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its turns in order; one row per conversation."""
    rows = turns.where("conv_id is not null").select("conv_id", F.struct("turn", "role", "text").alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_set("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def head(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), F.coalesce(t["text"], F.lit("")), F.lit(END))), "")


def trained(turns: Column) -> Column:
    """Start and end, in characters of the rendered turns, of what each assistant turn says."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(head(t["role"]))
        stop = begin + F.length(F.coalesce(t["text"], F.lit(""))) + len(END)
        span = F.struct(begin.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(t["role"] == ASSISTANT, F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step)["spans"]


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``pairs`` with ``prompt_turns``, ``prompt``, ``chosen_text``, ``chosen_spans``, ``rejected_text``, ``rejected_spans``.

    The columns ``chosen`` and ``rejected`` are arrays of structs with ``role`` and ``text``; columns with the
    names of the results are replaced.
    """
    names = ["prompt_turns", "prompt", "chosen_text", "chosen_spans", "rejected_text", "rejected_spans"]
    rows = pairs.drop(*[n for n in names if n not in (chosen, rejected)])
    none = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce(F.col(chosen), none), F.coalesce(F.col(rejected), none)
    shorter = F.least(F.size(a), F.size(b))
    unlike = F.filter(F.sequence(F.lit(1), shorter), lambda i: ~(F.get(a, i - 1)["role"].eqNullSafe(F.get(b, i - 1)["role"]) & F.get(a, i - 1)["text"].eqNullSafe(F.get(b, i - 1)["text"])))
    common = F.when(shorter == 0, F.lit(0)).otherwise(F.coalesce(F.array_min(unlike) - 1, shorter))
    rows = rows.withColumn("prompt_turns", common)
    rest = lambda x: F.slice(x, F.col("prompt_turns") + 1, F.greatest(F.size(x), F.lit(1)))
    return (rows.withColumn("prompt", rendered(F.slice(a, F.lit(1), F.col("prompt_turns"))))
            .withColumns({"chosen_text": rendered(rest(a)), "chosen_spans": trained(rest(a)),
                          "rejected_text": rendered(rest(b)), "rejected_spans": trained(rest(b))}))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """One pair per conversation: up to its last assistant turn, against the same with that turn of its neighbour.

    The neighbour has the id that differs in the last bit.  Without an assistant turn the
    whole conversation stands on both sides; without a neighbour's reply the rejected side ends before it.
    """
    convs = conversations(turns).withColumn("last", F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == ASSISTANT, i + 1))))
    reply = convs.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.when(F.col("last").isNotNull(), F.slice("turns", F.col("last"), F.lit(1))).alias("reply"))
    both = convs.join(reply, "conv_id", "left")
    before = F.slice("turns", F.lit(1), F.col("last") - 1)
    return both.select("conv_id", F.when(F.col("last").isNull(), F.col("turns")).otherwise(F.slice("turns", F.lit(1), F.col("last"))).alias("chosen"),
                       F.when(F.col("last").isNull(), F.col("turns")).when(F.col("reply").isNull(), before).otherwise(F.concat(before, "reply")).alias("rejected"))
