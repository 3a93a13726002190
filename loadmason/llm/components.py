"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import park, release

T = TypeVar("T")


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest reachable id) of every id that has an edge to another.

    ``edges`` has two long columns, in either order; nulls and loops are left
    out. Rounds alternate two steps until nothing changes: every id hands its
    smallest neighbour to its larger neighbours, then its smaller neighbours
    to the smallest of them. Minima are combined before they are shuffled, and
    written out, so that both sides of the join that follows are plain shuffles
    of which Spark can split the part of an id with very many edges.
    """
    first, second = (F.col(c) for c in edges.columns)
    pairs = edges.where(first != second).select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
    current, before = _counted(pairs.distinct())
    while True:
        # pairs that come up twice do no harm to the step that follows
        larger = _step(_to_larger, current, lambda moved: park(moved, "edges"))
        smaller, after = _step(_to_smallest, larger, lambda moved: _counted(moved.distinct()))
        release(current, larger)
        current = smaller
        if after == before:
            return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = after


def _step(move: Callable[[DataFrame, DataFrame], DataFrame], pairs: DataFrame, written: Callable[[DataFrame], T]) -> T:
    both = pairs
    if move is _to_larger:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = park(both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("w"), "low"), "lowest")
    moved = written(move(both, lowest))
    release(lowest)
    return moved


def _counted(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """The pairs, written out, and a digest of them taken as they were."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
    parked = park(pairs, "edges", (seen, F.count(F.lit(1)).alias("n"), digest))
    return parked, (seen.get["n"], seen.get["digest"])


def _to_larger(both: DataFrame, lowest: DataFrame) -> DataFrame:
    """Every id hands the smallest of itself and its neighbours to its larger neighbours."""
    joined = both.join(lowest, both["u"] == lowest["w"]).where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.least("w", "low").alias("v"))


def _to_smallest(pairs: DataFrame, lowest: DataFrame) -> DataFrame:
    """Every id hands its smallest neighbour to its other smaller ones."""
    moved = pairs.join(lowest, pairs["u"] == lowest["w"]).where(F.col("v") != F.col("low"))
    return moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(lowest.toDF("u", "v"))

