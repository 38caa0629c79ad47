"""Perspective rotation of multi-party dialogues.

Every participant of a conversation gets the whole dialogue once with that speaker as the assistant:
the speaker's turns are ``assistant`` turns and carry the training mask, everybody else is a named
``user``, system turns stay system turns. The result is one row per (conversation, perspective,
turn) with the rendered segment and its place in the rendered dialogue, so a conversation of any
length is written by many tasks; joining the segments in order gives the text, and
[loss_start, loss_end) are the characters to learn from.

Defined results: a participant is a distinct role that is neither null nor the system role; a
conversation without participants gives no rows; a turn with a null role is a user without a name;
a null text is empty; rows with a null conversation id are one conversation; turns that share a
number (or have none, which come first) follow each other by content; repeated rows stay repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_totals

SYSTEM = "system"
#: What stands before and after the text of a turn.
BEGIN, CLOSE, FINISH = "<|", "|>\n", "<|end|>\n"
#: Shares into which a conversation's turns are dealt before they meet its participants.
SALTS = 16


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, perspective and turn."""
    spoken = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    speakers = spoken.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select("conv", "role").distinct()
    seats = speakers.select(
        F.col("conv").alias("seat_conv"), F.col("role").alias("perspective"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("seat_salt"),
    )
    salted = spoken.withColumn("salt", F.pmod(F.xxhash64("turn", "content"), F.lit(SALTS)).cast("int"))
    met = salted.join(seats, F.col("conv").eqNullSafe(F.col("seat_conv")) & (F.col("salt") == F.col("seat_salt")))
    learned = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    speaker = F.when(learned, "assistant").when(F.col("role") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(F.col("speaker") == "user", F.coalesce("role", F.lit("")))
    header = F.concat(
        F.lit(BEGIN), F.col("speaker"), F.when(F.col("name") != "", F.concat(F.lit(" name="), F.col("name"))).otherwise(""), F.lit(CLOSE)
    )
    rendered = met.withColumn("speaker", speaker).withColumn("name", name).withColumn("head", F.length(header).cast("long"))
    rendered = rendered.withColumn("segment", F.concat(header, F.col("content"), F.lit(FINISH)))
    rendered = rendered.select(
        "conv", "perspective", "turn", "speaker", "name", "head", "segment",
        F.length("segment").cast("long").alias("width"), F.length("content").cast("long").alias("body"),
        F.xxhash64("role", "content").alias("tie"),
    )
    placed = running_totals(rendered, ["conv", "perspective"], "turn", {"start": "width"}, ties=["tie"])
    begin = F.col("start") + F.col("head")
    is_own = F.col("speaker") == "assistant"
    return placed.select(
        F.col("conv").alias(conversation), "perspective", F.col("turn").alias(turn), "speaker", "name", "segment",
        F.col("start").alias("segment_start"),
        F.when(is_own, begin).alias("loss_start"), F.when(is_own, begin + F.col("body")).alias("loss_end"),
    )
