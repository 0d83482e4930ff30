"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the whole dialogue is rendered with that
speaker as the assistant and all others as named users; system turns stay system
turns.  The mask holds the character spans [start, end) of the assistant's own words.

Long conversations are rendered in parts of ``part_turns`` turn numbers, so that no
group grows with a conversation; parts follow each other in ``part`` order.  All work
is done by built-in functions.

Defined results: exactly repeated rows of a turn count once; ties of a turn number
are ordered by role and text; a NULL turn comes first, in a part of its own; a NULL
role speaks as ``unknown``; a NULL text is empty; a NULL conversation id is a
conversation; a conversation of system turns alone has no perspective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYSTEM = "system"
PART_TURNS = 64


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per (conversation, participant, part): the rendered text, its mask spans and counts."""
    clean = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    part = F.floor(F.col("turn") / F.lit(part_turns)).cast("bigint").alias("part")
    parts = (clean.withColumn("part", part).groupBy("conv_id", "part")
             .agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns")))
    speakers = (clean.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("__c"), F.col("role").alias("speaker"))
                .distinct())
    both = parts.join(speakers, parts["conv_id"].eqNullSafe(speakers["__c"])).drop("__c")

    def head(t):
        return (F.when(t["role"] == SYSTEM, F.lit("<|system|>\n"))
                .when(t["role"] == F.col("speaker"), F.lit("<|assistant|>\n"))
                .otherwise(F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n"))))

    tail = "\n<|end|>\n"
    segments = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), t["text"].alias("text"), (t["role"] == F.col("speaker")).alias("own")))
    both = both.withColumn("segments", segments)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("array()").cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc, s):
        begin = acc["at"] + F.length(s["head"])
        end = begin + F.length(s["text"])
        span = F.array(F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct((end + F.lit(len(tail))).cast("bigint").alias("at"),
                        F.when(s["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return both.select(
        "conv_id", "speaker", "part", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["text"], F.lit(tail))), "").alias("rendered"),
        F.aggregate("segments", start, step, lambda acc: acc["spans"]).alias("mask"))
