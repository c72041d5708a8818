"""Chat formatting: every dialogue from the perspective of each of its participants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, END_OF_TURN = "<|im_start|>", "<|im_end|>", "\n"
SYSTEM, UNNAMED = "system", "unknown"
# Turn numbers rendered together; longer dialogues come in parts.
PART_TURNS = 64


def _turns(conversations: DataFrame, part_turns: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(F.col("turn") / part_turns).cast("long").alias("part"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(UNNAMED)).alias("role"),
        # Marks in a text must not pass for marks of the format.
        F.replace(text, F.lit("<|"), F.lit("<\\|")).alias("text"),
    )


def _name(role: Column) -> Column:
    """A name as a header shows it: in one line, and without marks of the format."""
    return F.translate(F.replace(role, F.lit("<|"), F.lit("<\\|")), "\r\n", "  ")


def _rendered(turn: Column, speaker: Column) -> Column:
    """A turn's text before and within the mask, as the speaker sees it."""
    head = (
        F.when(turn["role"] == speaker, F.lit("assistant"))
        .when(turn["role"] == SYSTEM, F.lit(SYSTEM))
        .otherwise(F.concat(F.lit("user name="), _name(turn["role"])))
    )
    return F.struct(
        F.concat(F.lit(OPEN), head, F.lit("\n")).alias("head"),
        F.concat(turn["text"], F.lit(CLOSE)).alias("body"),
        (turn["role"] == speaker).alias("own"),
    )


def rotated(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Renderings of every dialogue with each participant as the assistant.

    The others are users with their names; turns of the system stay the system's,
    who is no participant. Names can't forge a turn: their line breaks are spaces, their
    marks are escaped as in texts. A row without a role is by ``unknown``, a null text is
    empty, rows without ``conv_id`` are one dialogue, turns of one number are in
    order of role and text (null numbers last), and repeated rows stay repeated.

    Returns ``conv_id``, ``speaker``, ``part`` (turn numbers by the number in a
    part, so that no dialogue has to fit into one task), ``turns``, ``start`` (code
    points of the parts before), ``text`` and ``mask``, the spans of the part that
    count for the loss: the speaker's words and end marks.
    """
    turns = _turns(conversations, part_turns)
    speakers = turns.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    parts = turns.groupBy("conv_id", "part").agg(
        F.array_sort(
            F.collect_list(F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text"))
        ).alias("said")
    )
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "speaker", "part", F.transform("said", lambda t: _rendered(t, F.col("speaker"))).alias("said")
    )

    def step(done, turn):
        begin = done["at"] + F.length(turn["head"])
        end = begin + F.length(turn["body"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        return F.struct(
            (end + len(END_OF_TURN)).alias("at"),
            F.when(turn["own"], F.concat(done["mask"], F.array(span))).otherwise(done["mask"]).alias("mask"),
        )

    none = F.array().cast("array<struct<start:int,end:int>>")
    text = F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"], F.lit(END_OF_TURN))), "")
    done = seen.select(
        "conv_id",
        "speaker",
        "part",
        F.size("said").cast("long").alias("turns"),
        text.alias("text"),
        F.aggregate("said", F.struct(F.lit(0).alias("at"), none.alias("mask")), step, lambda d: d["mask"]).alias("mask"),
    )
    before = (
        Window.partitionBy("conv_id", "speaker")
        .orderBy(F.col("part").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = done.select("conv_id", "speaker", "part", F.length("text").cast("long").alias("size"))
    starts = sizes.select(
        F.col("conv_id").alias("c"),
        F.col("speaker").alias("s"),
        F.col("part").alias("p"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("speaker") == F.col("s")) & F.col("part").eqNullSafe(F.col("p"))
    )
    return done.join(starts, same).select("conv_id", "speaker", "part", "turns", "start", "text", "mask")
