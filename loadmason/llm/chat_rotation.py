"""Multi-party dialogues rendered once from every participant's point of view.

For each participant the dialogue is written with that speaker as the
assistant and all others as named users; system turns stay system turns. The
mask marks what the assistant says, with the end mark after it. Everything is
DataFrame expressions.

A dialogue may be far longer than others: its turns are numbered from a range
partitioning, which splits it over tasks, and every ``part_turns`` turns make a
row. So a row is bounded and no turn is dropped; most dialogues are one part.

Turns are ordered by ``turn`` (null first), then speaker, then text; equal rows
are turns of their own. A null text is an empty turn. A null or blank speaker
is an unnamed user and no participant. Turns without a dialogue id belong to no
dialogue. Template marks within a text are broken up, so that no text can end
its turn. Other columns are not read. A dialogue without participants, such as
one of system turns only, gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import park

PART_TURNS = 512
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """The turns with their place in their dialogue, from 0, none of them ranked in one task."""
    order = ["conv_id", "turn", "role", "text"]
    sorted_turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # counts up within a partition; the upper bits are the partition's number
    rows = park(sorted_turns.withColumn("n", F.monotonically_increasing_id()), "turns")
    rows = rows.withColumn("stretch", F.shiftright("n", 33))
    stretches = rows.groupBy("conv_id", "stretch").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.select("conv_id", "stretch", "first", F.coalesce(before, F.lit(0)).alias("before"))
    joined = rows.join(stretches, ["conv_id", "stretch"])
    return joined.select("conv_id", "role", "text", (F.col("n") - F.col("first") + F.col("before")).alias("place"))


def rotate(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id``, ``participant``, ``part``, ``n_turns``, ``n_own``, ``rendered`` and ``mask``: the
    stretches of characters of ``rendered`` that are the assistant's."""
    speaker = F.when(F.trim("role") != "", F.col("role"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", speaker.alias("role"), F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text")
    )
    numbered = numbered_turns(turns)
    people = numbered.where(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("participant")).distinct()
    own = F.coalesce(F.col("role") == F.col("participant"), F.lit(False))
    seen = numbered.join(people, "conv_id").select(
        "conv_id", "participant", F.floor(F.col("place") / part_turns).alias("part"), "place", "text",
        own.alias("own"), _header(own).alias("header"),
    )
    size = F.length("header") + F.length("text") + F.lit(len(END) + 1)
    view = ["conv_id", "participant", "part"]
    before = F.sum(size).over(Window.partitionBy(*view).orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    begin = F.coalesce(before, F.lit(0)) + F.length("header")
    pieces = seen.select(
        *view, "place", "own", F.concat("header", "text", F.lit(END + "\n")).alias("piece"),
        begin.alias("start"), (begin + F.length("text") + len(END)).alias("end"),
    )
    listed = pieces.groupBy(*view).agg(F.array_sort(F.collect_list(F.struct("place", "own", "piece", "start", "end"))).alias("turns"))
    mine = F.filter("turns", lambda t: t["own"])
    return listed.select(
        *view,
        F.size("turns").cast("long").alias("n_turns"),
        F.size(mine).cast("long").alias("n_own"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("rendered"),
        F.transform(F.filter("turns", lambda s: s["own"]), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias("mask"),
    )


def _header(own: Column) -> Column:
    name = F.regexp_replace("role", r"[\x00-\x20<|>]+", "_")
    return F.concat(
        F.lit(START),
        F.when(F.col("role") == SYSTEM, F.lit("system"))
        .when(own, F.lit("assistant"))
        .when(F.col("role").isNull(), F.lit("user"))
        .otherwise(F.concat(F.lit("user name="), name)),
        F.lit("\n"),
    )
