"""Multi-party perspective rotation: a dialogue rendered once per participant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.index import dense_index

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
NARRATORS = ("system",)
NAMELESS = "unknown"
PART_TURNS = 64
LEAD_CHARS = 32


def _plain(text: Column) -> Column:
    """Text in which no marker of the format can be read."""
    return F.replace(F.replace(text, F.lit(OPEN), F.lit("<| im_start|>")), F.lit(CLOSE), F.lit("<| im_end|>"))


def _in_parts(said: DataFrame, part_turns: int) -> DataFrame:
    """``said`` with ``_part``: a row's position in its conversation divided by ``part_turns``.

    Positions come from one global index, so neither a conversation nor a tie has to fit a task. Only
    a text's lead and hash are sort keys, because sampled range bounds reach the driver; ``_tie``
    spreads rows that are equal throughout.
    """
    keys = {"_lead": F.substring("_text", 1, LEAD_CHARS), "_hash": F.xxhash64("_text"), "_tie": F.monotonically_increasing_id()}
    placed = dense_index(said.withColumns(keys), ["_conv", "_turn", "_name", *keys], "_place").drop(*keys)
    first = placed.groupBy(F.col("_conv").alias("_of")).agg(F.min("_place").alias("_first"))
    return placed.join(first, placed["_conv"].eqNullSafe(first["_of"])).select(
        *said.columns, F.floor((F.col("_place") - F.col("_first")) / part_turns).alias("_part")
    )


def rotate_perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    narrators: Sequence[str] = NARRATORS,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """One row per (conversation, speaker, part): the dialogue with ``speaker`` as the assistant.

    Every participant is once the speaker; the others are users under their own names, narrators
    stay narrators and never speak. ``mask`` lists the [start, end) code points to learn from: the
    speaker's text and its end mark. Turns sort by (turn, role, text), NULL turns first: ties have one
    order, repeated rows stay. A part holds ``part_turns`` turns by position in that order, the last
    one what is left, so a long dialogue is several rows; joined in order of part they are the whole.
    Only between parts, ties that also agree in role and the text's first ``LEAD_CHARS`` characters go
    by the text's hash. A NULL or blank role is a participant called ``unknown``, a NULL text is empty,
    NULL conversations are one conversation.
    A conversation of narrators alone has no participant and no row.
    """
    name = F.coalesce(F.nullif(F.trim(F.regexp_replace(_plain(F.col(role)), r"[\r\n]+", " ")), F.lit("")), F.lit(NAMELESS))
    said = turns.select(
        F.col(conversation).alias("_conv"),
        F.col(turn).alias("_turn"),
        name.alias("_name"),
        _plain(F.coalesce(F.col(text), F.lit(""))).alias("_text"),
    )
    parts = _in_parts(said, part_turns).groupBy("_conv", "_part").agg(F.sort_array(F.collect_list(F.struct("_turn", "_name", "_text"))).alias("_turns"))
    speakers = said.filter(~F.col("_name").isin(*narrators)).select("_conv", F.col("_name").alias("speaker")).distinct()
    both = parts.join(speakers, parts["_conv"].eqNullSafe(speakers["_conv"])).drop(speakers["_conv"])

    def segment(t: Column) -> Column:
        who = (
            F.when(t["_name"] == F.col("speaker"), "assistant")
            .when(t["_name"].isin(*narrators), t["_name"])
            .otherwise(F.concat(F.lit("user name="), t["_name"]))
        )
        head = F.concat(F.lit(OPEN), who, F.lit("\n"))
        body = F.concat(t["_text"], F.lit(CLOSE))
        return F.struct(head.alias("head"), body.alias("body"), (t["_name"] == F.col("speaker")).alias("own"))

    def walk(state: Column, s: Column) -> Column:
        start = state["at"] + F.length(s["head"])
        end = start + F.length(s["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct((end + 1).alias("at"), F.when(s["own"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))
    cut = both.withColumn("_segments", F.transform("_turns", segment))
    return cut.select(
        F.col("_conv").alias(conversation),
        "speaker",
        F.col("_part").alias("part"),
        F.size("_turns").alias("n_turns"),
        F.concat(F.array_join(F.transform("_segments", lambda s: F.concat(s["head"], s["body"])), "\n"), F.lit("\n")).alias("rendered"),
        F.aggregate("_segments", empty, walk, lambda s: s["mask"]).alias("mask"),
    )
