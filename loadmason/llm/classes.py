"""From links between classes of equal rows to groups of ids.

A class has a number of its own (``id``), whatever ids its rows have: rows that share an id may be
of several classes. Links are found between classes; only here do they become groups of ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import park
from .components import components


def grouped(classes: DataFrame, linked: DataFrame) -> DataFrame:
    """The classes (``id``, ``weight``, ``least``) with ``n_links`` and ``first``, the smallest ``least`` that links lead to.

    ``linked`` is what ``tile_links`` gives. The smallest ones are written out,
    so that Spark can split the part of a group with very many classes.
    """
    labels = components(linked.select("id", "root"))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    joined = classes.join(labels, "id", "left").join(links, "id", "left")
    found = park(joined, "grouped")
    several = found.where("component IS NOT NULL")
    firsts = park(several.groupBy("component").agg(F.min("least").alias("first")), "firsts")
    whole = found.where("component IS NULL").withColumn("first", F.col("least")).unionByName(several.join(firsts, "component"))
    kept = [c for c in classes.columns if c not in ("id", "weight", "least")]
    return whole.select(*kept, "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))


def groups_of_rows(rows: DataFrame, by_class: DataFrame) -> DataFrame:
    """The rows with ``component_id`` and ``n_links``; rows that share an id have the same of both.

    ``rows`` has ``id``, ``h1`` and ``h2`` (null without a class), ``by_class`` has ``h1``, ``h2``,
    ``component_id`` and ``n_links``. An id with several classes joins their groups and has the
    links of each of these classes.
    """
    differ = (F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2")) | F.count("h1").between(1, F.count(F.lit(1)) - 1)
    several = rows.where(F.col("id").isNotNull()).groupBy("id").agg(differ.alias("several"))
    several = park(several.where("several").select("id"), "ids-of-several")
    keys = ["h1", "h2"]
    if several.isEmpty():
        joined = rows.join(by_class, keys, "left")
        return joined.withColumns({"component_id": F.coalesce("component_id", "id"), "n_links": F.coalesce("n_links", F.lit(0))})

    held = rows.join(several, "id").select("id", *keys).distinct().join(by_class, keys)
    held = park(held.select("id", *keys, "component_id", "n_links"), "classes-of-ids")
    labels = park(components(held.select("id", "component_id")), "labels")
    labels = labels.select(F.col("id").alias("component_id"), F.col("component").alias("__joined"))
    by_id = held.groupBy("id").agg(F.min("component_id").alias("component_id"), F.sum("n_links").alias("__links"))
    joined = F.coalesce("__joined", "component_id")
    by_id = by_id.join(labels, "component_id", "left").select("id", joined.alias("__component"), "__links")
    by_class = by_class.join(labels, "component_id", "left").select(*keys, joined.alias("component_id"), "n_links")
    found = rows.join(park(by_class, "classes-joined"), keys, "left").join(park(by_id, "ids-joined"), "id", "left")
    return found.withColumns(
        {
            "component_id": F.coalesce("__component", "component_id", "id"),
            "n_links": F.coalesce("__links", "n_links", F.lit(0)),
        }
    ).drop("__component", "__links")
