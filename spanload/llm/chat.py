"""Chat formatting: the same dialogue from the side of every participant.

For each participant of a conversation the dialogue is rendered with that speaker as the
assistant, all others as named users, and with the character spans a model should learn
(the assistant's texts and end marks).  Built-in SQL functions only.

A conversation is cut into segments by turn number (``block`` turns each), so that one
that holds a third of all rows is rendered by many tasks; each segment is a text of its
own with its own spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of the rendered form.
SYSTEM, ASSISTANT, USER, END = "<|system|>", "<|assistant|>", "<|user:{}|>", "<|end|>"


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", block: int = 256, system: Sequence[str] = ("system",)) -> DataFrame:
    """Columns ``conv_id, segment, speaker, n_turns, chat, mask, n_masked, n_chars``.

    One row for each conversation, segment and participant (distinct roles but for the
    ``system`` ones).  ``mask``: ``start-end`` character offsets into ``chat``, end
    exclusive, joined by commas; empty where the speaker says nothing in the segment.

    Turns are in order of (turn, role, text), nulls first.  Wholly repeated rows are one
    turn; several texts of one turn number all stay.  A null turn number counts as segment
    -1; a null role is shown as the user ``unknown`` and is no participant; a null text is
    empty; a null conversation id is a conversation.  A conversation without participants
    gives no row, nor does an empty table.  Other columns are not looked at.
    """
    turns = df.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("_turn"),
                      F.col(f"`{role}`").alias("_role"), F.col(f"`{text}`").alias("_text")).distinct()
    segments = (turns
                .groupBy("conv_id", F.coalesce(F.floor(F.col("_turn") / block), F.lit(-1))
                         .cast("long").alias("segment"))
                .agg(F.sort_array(F.collect_list(F.struct("_turn", "_role", "_text"))).alias("_turns")))
    speakers = (df.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{role}`").alias("speaker"))
                .where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*system)).distinct())
    seen = segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    def parts(t):
        name = F.coalesce(t["_role"], F.lit("unknown"))
        own = F.coalesce(t["_role"] == F.col("speaker"), F.lit(False))
        before, after = USER.split("{}")
        head = (F.when(own, F.lit(ASSISTANT + "\n"))
                .when(name.isin(*system), F.lit(SYSTEM + "\n"))
                .otherwise(F.concat(F.lit(before), name, F.lit(after + "\n"))))
        body = F.concat(F.coalesce(t["_text"], F.lit("")), F.lit(END))
        return F.struct(own.alias("own"), head.alias("head"), body.alias("body"))

    def step(acc, p):
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(
            (end + 1).alias("at"),
            F.when(~p["own"], acc["mask"]).when(acc["mask"] == "", span)
            .otherwise(F.concat(acc["mask"], F.lit(","), span)).alias("mask"),
            (acc["n"] + F.when(p["own"], F.length(p["body"])).otherwise(0)).alias("n"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"), F.lit(0).alias("n"))
    return (seen.withColumn("_parts", F.transform("_turns", parts))
            .withColumn("_spans", F.aggregate("_parts", start, step))
            .select("conv_id", "segment", "speaker", F.size("_turns").cast("long").alias("n_turns"),
                    F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))),
                                 "").alias("chat"),
                    F.col("_spans.mask").alias("mask"), F.col("_spans.n").cast("long").alias("n_masked"),
                    F.col("_spans.at").cast("long").alias("n_chars")))
