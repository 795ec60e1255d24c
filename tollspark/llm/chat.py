"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant, every other speaker
as a named user and system turns as they are; the loss mask covers the contents of the assistant's turns. A long
conversation is rendered in parts of `span` turn numbers, so one conversation never has to fit into one row; the parts
of a perspective follow each other by `part`.

Turns that repeat in every column are one turn. A null speaker is called `unknown`, a null text is empty, turns without
a number come last (part -1), and turns without conversation form one of their own. Control marks inside a text are
broken up, so a text can't end its own turn. A conversation of system turns only has no perspective and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _head(speaker: Column, perspective: Column) -> Column:
    role = F.when(speaker == "system", "system").when(speaker == perspective, "assistant") \
        .otherwise(F.concat(F.lit("user name="), speaker))
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def rotate(turns: DataFrame, span: int = 64) -> DataFrame:
    """Per conversation, participant and part: conv_id, perspective, part, n_turns, text and spans, the (begin, end)
    code points of `text` that carry loss. `turns` has conv_id, turn, role (the speaker) and text."""
    body = F.replace(F.coalesce("text", F.lit("")), F.lit("<|im_"), F.lit("< |im_"))
    rows = turns.select("conv_id", F.coalesce(F.floor(F.col("turn") / span).cast("long"), F.lit(-1)).alias("part"),
                        F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), body.alias("body"))
                        .alias("said"))
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_set("said")).alias("said"))
    speakers = rows.where("said.speaker != 'system'").select("conv_id", F.col("said.speaker").alias("perspective")) \
        .distinct().withColumnRenamed("conv_id", "conv")
    views = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")))
    me = F.col("perspective")
    pieces = F.transform("said", lambda said: F.struct(
        F.length(_head(said.speaker, me)).alias("head"), F.length(said.body).alias("length"),
        (said.speaker == me).alias("mine"),
        F.concat(_head(said.speaker, me), said.body, F.lit(CLOSE + "\n")).alias("text")))
    views = views.select("conv_id", "perspective", "part", pieces.alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    placed = F.aggregate("pieces", start, lambda seen, piece: F.struct(
        (seen.at + F.length(piece.text)).alias("at"),
        F.when(piece.mine, F.concat(seen.spans, F.array(F.struct(
            (seen.at + piece["head"]).alias("begin"), (seen.at + piece["head"] + piece["length"]).alias("end")))))
        .otherwise(seen.spans).alias("spans")))
    return views.select("conv_id", "perspective", "part", F.size("pieces").cast("long").alias("n_turns"),
                        F.array_join(F.col("pieces.text"), "").alias("text"), placed["spans"].alias("spans"))
