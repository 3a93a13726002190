"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) are drawn from the data. Each vector is described
by its nearest pivots in order, and entered in the inverted list of each of
them. Vectors of one list that share enough pivots are compared exactly, by
cosine in double precision. Long lists are cut into blocks, and no task gives
out pairs, only link counts and one connection for each vector.

A pair is compared in the list of the smallest pivot both have, so it counts
once. The number of pivots grows with the square root of the number of
vectors, so that lists grow with it too and not with the number itself; it is
bounded, as the pivots are sent to every task (``MAX_PIVOTS``). A list that is
long all the same is kept by pairs of shared pivots, of which there are many
more: a third of all vectors near one pivot make no list of that length.

Vectors that are null or zero, or that hold null or non-finite components, are
linked with nothing, and vectors of different lengths not with each other.
Equal vectors are compared once, as a class with a number of its own. Rows that share an id are
one vector with the links of all of them, also where they hold different vectors; a row without
an id is left alone. Other columns are not read, so labels play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .classes import grouped, groups_of_rows
from .common import park
from .tiles import tile_links, tile_tasks

COSINE = 0.95
# How many of the nearest pivots describe a vector, and how many two vectors must share.
NEAREST, SHARED = 8, 2
# Longer inverted lists are kept by pairs of pivots instead.
LONG_LIST = 20_000
# Pivots: this many times the square root of the number of vectors, within bounds.
PIVOT_FACTOR, MIN_PIVOTS, MAX_PIVOTS = 4.0, 32, 16384
# No two pivots are this near.
PIVOT_COSINE = 0.9


def usable(column: str) -> F.Column:
    """Whether a vector has a direction."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0)


def draw_pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """At most ``MAX_PIVOTS`` unit vectors from the data: those with the smallest hashes."""
    wanted = min(MAX_PIVOTS, max(MIN_PIVOTS, math.ceil(PIVOT_FACTOR * math.sqrt(count))))
    # only about twice as many as are wanted are sorted
    share = min(1.0, 2.0 * wanted / max(count, 1))
    chance = F.pmod("h1", F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30)))
    rows = vectors.where(chance).orderBy("h1", "h2").limit(wanted).select("vector").collect()
    found = np.array([r.vector for r in rows], np.float64)
    return spread_out(found / np.linalg.norm(found, axis=1, keepdims=True))


def spread_out(unit: np.ndarray) -> np.ndarray:
    """The vectors less those very near to one before them: a crowd of near copies needs few pivots."""
    kept = np.empty_like(unit)
    n = 0
    for one in unit:
        if not n or (kept[:n] @ one).max() < PIVOT_COSINE:
            kept[n] = one
            n += 1
    return kept[:n]


def link_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links) and ``kept`` (is that its own)."""
    spark = rows.sparkSession
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    # equal vectors, by a 128-bit hash, are one class, combined before they are shuffled
    fit = F.col("id").isNotNull() & usable("vector")
    hashes = [F.when(fit, F.xxhash64(F.lit(salt), "vector")).alias(f"h{salt}") for salt in (1, 2)]
    hashed = named.select("id", "vector", *hashes)
    same = hashed.where(F.col("h1").isNotNull()).groupBy("h1", "h2")
    found = same.agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"), F.any_value("vector").alias("vector"))
    classes = park(found.withColumn("id", F.monotonically_increasing_id()), "vectors")
    # vectors of different lengths have no cosine; each length is a space of its own
    linked = spark.createDataFrame([], "id long, links long, root long")
    for row in classes.groupBy(F.size("vector").alias("size")).count().where("count > 1").orderBy("size").collect():
        of_size = classes.where(F.size("vector") == row["size"])
        found = _compared(of_size, draw_pivots(of_size, row["count"]), cosine, nearest, shared)
        linked = linked.unionByName(park(found, "links"))

    found = grouped(classes.select("id", "h1", "h2", "weight", "least"), linked)
    by_class = park(found.withColumnRenamed("first", "component_id"), "vector-classes")
    joined = groups_of_rows(hashed.select("id", "h1", "h2"), by_class)
    return joined.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def _compared(classes: DataFrame, pivots: np.ndarray, cosine: float, nearest: int, shared: int) -> DataFrame:
    size, taken = pivots.shape[1], min(nearest, len(pivots))
    needed = min(shared, taken)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "weight", "payload", "nearest"]
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                unit = np.array(part.column("vector").to_pylist(), np.float64).reshape(-1, size)
                # the largest component first, so that no square is lost or overflows
                unit = unit / np.abs(unit).max(axis=1, keepdims=True)
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                order = nearest_pivots(unit, pivots, taken)
                payload = [u.tobytes() + o.tobytes() for u, o in zip(unit, order, strict=True)]
                columns = [part.column("id"), part.column("weight"), pa.array(payload, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(order), pa.list_(pa.int32()))], names=names)

    described = classes.select("id", "weight", "vector").mapInArrow(describe, "id long, weight long, payload binary, nearest array<int>")
    described = park(described, "permutations")
    bytes_each = F.lit(8 * size + 4 * taken).cast("long")
    lists = inverted_lists(described, needed)
    members = lists.select("id", "grp", F.lit(0).alias("band"), bytes_each.alias("bytes"))
    tasks = tile_tasks(members).select(F.col("id").alias("__id"), "tasks")
    entries = described.join(tasks, described["id"] == tasks["__id"]).select("id", "weight", "payload", "tasks")

    def link(task: str, left: list[bytes], right: list[bytes] | None) -> np.ndarray:
        a = _unpack(left, size, taken)
        b = a if right is None else _unpack(right, size, taken)
        return near(a, b, int(task.split(":")[0]), cosine, needed)

    return tile_links(entries, link)


def inverted_lists(described: DataFrame, needed: int, long_list: int | None = None) -> DataFrame:
    """``id`` and ``grp``, the lists each vector is in: those of its pivots, or of pairs of them where a pivot's list is long.

    Two vectors that share two pivots share the pair of the two smallest of
    these as well. There are so many more pairs that their lists stay short
    where the pivots' no longer do.
    """
    long_list = LONG_LIST if long_list is None else long_list
    listed = described.select("id", "nearest", F.explode("nearest").alias("pivot"))
    if needed < 2:
        return listed.select("id", F.col("pivot").cast("long").alias("grp"))
    # one row a pivot at most
    sizes = described.select(F.explode("nearest").alias("pivot")).groupBy("pivot").count()
    long_ones = park(sizes.where(F.col("count") > long_list).select("pivot"), "long-lists")
    single = listed.join(F.broadcast(long_ones), "pivot", "left_anti").select("id", F.col("pivot").cast("long").alias("grp"))
    paired = listed.join(F.broadcast(long_ones), "pivot").withColumn("second", F.explode(F.filter("nearest", lambda p: p > F.col("pivot"))))
    return single.unionByName(paired.select("id", ((F.col("pivot").cast("long") + 1) * (1 << 32) + F.col("second")).alias("grp")))


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, taken: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first; equally near ones by number."""
    similar = unit @ pivots.T
    if taken < similar.shape[1]:
        some = np.sort(np.argpartition(-similar, taken - 1, axis=1)[:, :taken], axis=1)
    else:
        some = np.tile(np.arange(similar.shape[1]), (len(unit), 1))
    order = np.argsort(-np.take_along_axis(similar, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1).astype(np.int32)


def _unpack(payload: list[bytes], size: int, taken: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(payload), np.uint8).reshape(len(payload), 8 * size + 4 * taken)
    return rows[:, : 8 * size].copy().view(np.float64), rows[:, 8 * size :].copy().view(np.int32)


def near(a: tuple, b: tuple, grp: int, cosine: float, needed: int) -> np.ndarray:
    """Links between the vectors of two blocks of a list: enough shared pivots, the list's the smallest, near enough."""
    numbers = np.unique(np.concatenate([a[1].ravel(), b[1].ravel()]))
    a_has, b_has = _has(a[1], numbers), _has(b[1], numbers)
    counts = a_has @ b_has.T
    # of a pair's list, only the first of the two is shared below the second
    pair = grp >> 32
    below = numbers < (grp & ((1 << 32) - 1))
    first = a_has[:, below] @ b_has[:, below].T == (1 if pair else 0)
    matrix = (counts >= needed) & first & (a[0] @ b[0].T >= cosine)
    if a is b:
        np.fill_diagonal(matrix, False)
        matrix |= matrix.T
    return matrix


def _has(order: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    out = np.zeros((len(order), len(numbers)), np.float32)
    out[np.arange(len(order))[:, None], np.searchsorted(numbers, order)] = 1
    return out
