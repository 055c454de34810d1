"""Preference formatting: one prompt and two completions from a pair of conversations.

The turns that both conversations begin with are rendered once, as the prompt. What follows in
each of them is its completion, given as segments of which only the assistants' contents are
trained on. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The turn template: what stands before the role, between role and content, and after it.
OPEN, CLOSE, END = "<|", "|>\n", "\n"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        _header(t), t["text"], F.lit(END))), "")


def _segments(turns: Column, trained_role: str) -> Column:
    """The template's text and the contents, in order, each with its mask."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(_header(t).alias("content"), F.lit(False).alias("trained")),
        F.struct(F.concat(t["text"], F.lit(END)).alias("content"),
                 (t["role"] == trained_role).alias("trained")))))


def preferences(turns: DataFrame, pair: Column, is_chosen: Column, order: str = "turn",
                role: str = "role", text: str = "text", trained_role: str = "assistant"
                ) -> DataFrame:
    """One row per pair: ``pair_id``, ``n_common`` turns, ``prompt``, ``chosen``, ``rejected``.

    ``pair`` names the pair that a turn belongs to and ``is_chosen`` its side. Turns are compared
    by role and text; a null of either counts as empty. Turns of equal order (null first) follow
    by role and text; repeated rows are turns of their own. Equal conversations have two empty
    completions. A side without turns is a null completion, and the prompt then is empty. Turns
    without a pair or a side can't be placed and form no row.
    """
    turn = F.struct(F.col(f"`{order}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sides = turns.select(pair.alias("pair_id"), is_chosen.alias("side"), turn.alias("turn")) \
        .where("pair_id is not null and side is not null") \
        .groupBy("pair_id").agg(
            F.sort_array(F.collect_list(F.when(F.col("side"), F.col("turn")))).alias("a"),
            F.sort_array(F.collect_list(F.when(~F.col("side"), F.col("turn")))).alias("b"))
    same = F.zip_with("a", "b", lambda x, y: F.coalesce(
        (x["role"] == y["role"]) & (x["text"] == y["text"]), F.lit(False)))
    differs = F.array_position(same, False)  # from 1; 0 if both are equal
    both = sides.withColumn("n_common", F.when(differs > 0, differs - 1)
                            .otherwise(F.size("a").cast("long")))

    def completion(side: str) -> Column:
        rest = F.slice(F.col(side), F.col("n_common").cast("int") + 1,
                       F.greatest(F.size(side), F.lit(1)))
        return F.when(F.size(side) > 0, _segments(rest, trained_role))

    return both.select(
        "pair_id", "n_common",
        _rendered(F.slice("a", F.lit(1), F.col("n_common").cast("int"))).alias("prompt"),
        completion("a").alias("chosen"), completion("b").alias("rejected"))


def completion_text(segments: Column) -> Column:
    """The completion as one string."""
    return F.array_join(F.transform(segments, lambda s: s["content"]), "")


def completion_mask(segments: Column) -> Column:
    """The mask as text: each segment's length in characters, ``+`` where it is trained on."""
    return F.array_join(F.transform(segments, lambda s: F.concat(
        F.length(s["content"]).cast("string"), F.when(s["trained"], "+").otherwise("-"))), " ")
