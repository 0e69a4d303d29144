"""Preference formatting of chosen and rejected conversations, in Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED = "assistant"


def _turn(t: Column) -> Column:
    return F.concat(_head(t), _body(t))


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def _body(t: Column) -> Column:
    return F.concat(t["text"], F.lit("<|end|>\n"))


def _spans(turns: Column) -> Column:
    """Half-open code point ranges of a completion that count for training: what the assistant says, and its end mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        lo = a["at"] + F.char_length(_head(t)).cast("long")
        hi = lo + F.char_length(_body(t)).cast("long")
        own = F.array(F.struct(lo.alias("start"), hi.alias("end")))
        return F.struct(hi.alias("at"), F.when(t["role"] == TRAINED, F.concat(a["spans"], own)).otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda a: a["spans"])


def conversations_of(turns: DataFrame) -> DataFrame:
    """One row for each conv_id: its turns in order. One conversation is one record."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("user")).alias("role"), text.alias("text")).alias("t"),
    )
    return each.groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per row of ``pairs`` (pair_id, chosen, rejected: conv_ids): prompt, completions and their training spans.

    ``turns`` (conv_id, turn, role, text). The longest common prefix of turns, equal in role and text, is rendered once as the
    prompt; what follows in each is its completion. chosen_spans and rejected_spans are ranges of code points of the
    completions that train; all else, and the prompt, is masked.

    Turns are ordered by number, ties by role and text; a repeated row counts once; null text is empty, null role is user, a
    null turn number comes first, a null conv_id is left out. A pair of which one conversation has no turns is left
    out. Equal conversations have empty completions. Other columns are not read.
    """
    convs = conversations_of(turns)
    wide = (
        pairs.select("pair_id", "chosen", "rejected")
        .join(convs.select(F.col("conv_id").alias("chosen"), F.col("turns").alias("c")), "chosen")
        .join(convs.select(F.col("conv_id").alias("rejected"), F.col("turns").alias("r")), "rejected")
    )
    return _render(wide)


def format_neighbours(turns: DataFrame) -> DataFrame:
    """:func:`format_pairs` of the pairs (2k, 2k + 1): the even conv_id as chosen, the odd one as rejected, by one shuffle more than the turns' own.

    A conversation without its partner shares no turn: the prompt is empty, its text is the completion, and the other side's columns are null.
    """
    convs = conversations_of(turns).withColumn("pair_id", F.shiftright(F.col("conv_id"), 1))
    even = F.col("conv_id").bitwiseAND(F.lit(1)) == 0
    return _render(convs.groupBy("pair_id").agg(
        F.max(F.when(even, F.col("conv_id"))).alias("chosen"), F.max(F.when(~even, F.col("conv_id"))).alias("rejected"),
        F.max(F.when(even, F.col("turns"))).alias("c"), F.max(F.when(~even, F.col("turns"))).alias("r"),
    ))


def _render(wide: DataFrame) -> DataFrame:
    c, r = F.col("c"), F.col("r")
    both = F.when(c.isNull() | r.isNull(), 0).otherwise(F.least(F.size(c), F.size(r)))
    same = lambda i: (F.get(c, i)["role"] == F.get(r, i)["role"]) & (F.get(c, i)["text"] == F.get(r, i)["text"])
    first = F.when(both > 0, F.array_min(F.filter(F.sequence(F.lit(0), F.greatest(both - 1, F.lit(0))), lambda i: ~same(i))))
    wide = wide.withColumn("n_shared", F.coalesce(first, both))
    after = lambda x: F.slice(x, F.col("n_shared") + 1, F.greatest(F.size(x) - F.col("n_shared"), F.lit(0)))
    wide = wide.withColumns({"p": F.slice(F.coalesce(c, r), F.lit(1), F.col("n_shared")), "c": after(c), "r": after(r)})
    text = lambda x: F.array_join(F.transform(x, _turn), "")
    return wide.select(
        "pair_id", "chosen", "rejected", F.col("n_shared").cast("long").alias("n_shared"), text("p").alias("prompt"), text("c").alias("chosen_text"), text("r").alias("rejected_text"),
        _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"),
    )
