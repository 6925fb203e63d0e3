"""Preference pairs as a shared prompt and two masked completions, with DataFrame functions only.

The turns of both conversations of a pair meet in one grouping. Their longest common prefix of turns (equal role and
text) is rendered once as the prompt; what follows in each is its completion, with the spans that count for a loss: the
texts of the assistant's turns. Spans are code points of prompt followed by completion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column, begin: Column, learn_from: str) -> Column:
    """start:end of the texts of learn_from's turns, comma-joined."""
    start = F.struct(begin.cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = state["at"] + F.length(turn["role"]) + 5  # <| and |> and a line end
        last = first + F.length(turn["text"])
        span = F.array(F.concat_ws(":", first.cast("string"), last.cast("string")))
        return F.struct((last + 8).alias("at"), F.when(turn["role"] == learn_from, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.array_join(F.aggregate(turns, start, step)["spans"], ",")


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn_from: str = "assistant") -> DataFrame:
    """One row per pair: pair_id, status, n_prefix, n_chosen, n_rejected, prompt, chosen, rejected, chosen_spans, rejected_spans.

    pair gives each turn its pair, chosen is true for turns of the preferred conversation and false for the other's. Turns
    where either is null belong to no pair and are left out. Turns go by number, then role, then text, so that ties and
    repeated rows have one order; repeated rows stay. Null roles and texts are empty, null numbers come first.
    status: pair; identical, where the prompt holds everything and both completions are empty; chosen_only and
    rejected_only, where the other side has no turns, so prompt and the other completion are empty. An empty table gives no
    rows. A very long text is rendered whole: the turns of one pair meet in one row. Other columns are not read.
    """
    prepare(turns.sparkSession)
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.select(pair.alias("pair_id"), chosen.alias("side"), turn.alias("t")).where("pair_id is not null and side is not null")
    both = rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.when(F.col("side"), F.col("t")))).alias("c"), F.array_sort(F.collect_list(F.when(~F.col("side"), F.col("t")))).alias("r"))
    said = lambda t: F.struct(t["role"], t["text"])
    same = F.transform(F.arrays_zip(F.transform("c", said).alias("x"), F.transform("r", said).alias("y")), lambda z: z["x"].eqNullSafe(z["y"]))
    differs = F.array_position(same, F.lit(False))
    both = both.select("*", F.size("c").alias("n_chosen"), F.size("r").alias("n_rejected")).withColumn("n_prefix", F.when(differs > 0, differs - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda c: F.slice(c, F.col("n_prefix") + 1, F.greatest(F.size(c) - F.col("n_prefix"), F.lit(0)))
    both = both.select("*", _joined(F.slice("c", 1, F.col("n_prefix"))).alias("prompt"), rest("c").alias("c_rest"), rest("r").alias("r_rest"))
    status = F.when(F.col("n_rejected") == 0, "chosen_only").when(F.col("n_chosen") == 0, "rejected_only").when((F.col("n_prefix") == F.col("n_chosen")) & (F.col("n_prefix") == F.col("n_rejected")), "identical").otherwise("pair")
    begin = F.length("prompt")
    return both.select(
        "pair_id", status.alias("status"), "n_prefix", "n_chosen", "n_rejected", "prompt", _joined(F.col("c_rest")).alias("chosen"), _joined(F.col("r_rest")).alias("rejected"),
        _spans(F.col("c_rest"), begin, learn_from).alias("chosen_spans"), _spans(F.col("r_rest"), begin, learn_from).alias("rejected_spans"),
    )
