"""Multi-party perspective rotation of dialogues.

Every participant gets a view of the dialogue in which their own turns are the
assistant's and are trained on, and the others' are those of named users. A
dialogue is cut into parts of a bounded number of turns, so one that holds a
third of all turns is never one row; parts in order give the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import ranked


@dataclass(frozen=True)
class ChatFormat:
    """Markers of a turn, roles that are shown to all and never trained on, turns per part."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>"
    system: tuple[str, ...] = ("system",)
    unnamed: str = "unknown"
    part_turns: int = 64


def rotate(turns: DataFrame, form: ChatFormat = ChatFormat(), *, dialogue: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """One row per dialogue, participant and part.

    Columns: ``conv_id``, ``perspective`` (the participant), ``part`` (from 0),
    ``first_turn`` (place of the part's first turn, from 0), ``turns``, ``text``
    and ``spans``, the ``[start, stop)`` character ranges to train on, counted
    from the part's begin: the contents of the participant's own turns and
    their end markers.

    Turns are ordered by turn number (NULL last), then speaker and text; repeated
    turns are kept. A NULL text is empty. A NULL or blank speaker is the
    participant ``unnamed``. A NULL dialogue id is a dialogue of its own. A
    dialogue of system turns alone has no participant and no row. Markers inside
    a text are broken by a space, so they cannot end a turn. Other columns are
    ignored. An empty table gives an empty one.
    """
    name = F.trim(F.col(speaker).cast("string"))
    body = F.coalesce(F.col(text), F.lit(""))
    for marker in (form.start, form.end):
        body = F.replace(body, F.lit(marker), F.lit(marker[0] + " " + marker[1:]))
    said = turns.select(
        F.col(dialogue).alias("conv_id"),
        F.col(turn).alias("_turn"),
        F.when(F.coalesce(name, F.lit("")) == "", F.lit(form.unnamed)).otherwise(name).alias("_who"),
        body.alias("_body"),
    )
    order = [F.col("_turn").asc_nulls_last(), F.col("_who"), F.col("_body")]
    placed = ranked(said, ["conv_id"], order, "_place")
    parts = (
        placed.withColumn("part", F.floor(F.col("_place") / form.part_turns).cast("int"))
        .groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(F.struct("_place", "_who", "_body"))).alias("_turns"))
    )
    people = placed.filter(~F.col("_who").isin(*form.system)).select(F.col("conv_id").alias("_of"), F.col("_who").alias("perspective")).distinct()
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("_of")))

    def head(t: Column) -> Column:
        role = (
            F.when(t["_who"].isin(*form.system), F.lit("system"))
            .when(t["_who"] == F.col("perspective"), F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), t["_who"]))
        )
        return F.concat(F.lit(form.start), role, F.lit("\n"))

    def piece(t: Column) -> Column:
        own = (t["_who"] == F.col("perspective")) & ~t["_who"].isin(*form.system)
        return F.struct(head(t).alias("head"), F.concat(t["_body"], F.lit(form.end)).alias("body"), own.alias("own"))

    pieces = views.withColumn("_pieces", F.transform("_turns", piece))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(so_far: Column, p: Column) -> Column:
        start = so_far["at"] + F.length(p["head"])
        stop = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct((stop + 1).alias("at"), F.when(p["own"], F.concat(so_far["spans"], span)).otherwise(so_far["spans"]).alias("spans"))

    return pieces.select(
        "conv_id",
        "perspective",
        "part",
        F.element_at("_turns", 1)["_place"].alias("first_turn"),
        F.size("_turns").alias("turns"),
        F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.aggregate("_pieces", nothing, step, lambda done: done["spans"]).alias("spans"),
    )
