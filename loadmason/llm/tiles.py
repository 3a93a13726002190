"""Comparing all members of groups of any size, in tiles of bounded size.

A group is cut into blocks. Every pair of blocks that can hold links is a task
of its own, so a group with a third of all rows becomes many tasks, none of
which grows with it. A task never gives out its pairs: it gives, for each
member, how much it is linked to and one member it is connected with, from
which counts and components are put together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back

# Members and bytes of a block, about.
BLOCK_ROWS = 512
BLOCK_BYTES = 8 << 20
# Members of a block where only bitmaps are compared.
ROOT_ROWS = 4096


def tile_tasks(members: DataFrame, rows: int = BLOCK_ROWS, size: int = BLOCK_BYTES) -> DataFrame:
    """The members with ``tasks``: each task's name, and 0 where all of a member's block are compared
    with each other, 1 or 2 for the two sides of a pair of blocks.

    ``members`` has ``id``, ``grp``, ``band`` (only members of the same or of
    neighbouring bands can be linked) and ``bytes``.
    """
    per_band = members.groupBy("grp", "band").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("n") / rows), F.ceil(F.col("bytes") / size), F.lit(1)).cast("int")
    info = per_band.groupBy("grp").agg(
        ((F.sum("n") <= rows) & (F.sum("bytes") <= size)).alias("whole"),
        F.map_from_entries(F.collect_list(F.struct("band", blocks.alias("n")))).alias("blocks"),
    )
    info = info.withColumnRenamed("grp", "__grp")
    joined = members.join(info, members["grp"] == info["__grp"])
    own = F.expr("try_element_at(blocks, band)")
    joined = joined.withColumn("i", F.when(F.col("whole"), 0).otherwise(F.pmod(F.xxhash64("id"), own)))
    # a band that is not there has no blocks
    tasks = """
        CASE WHEN whole THEN array(named_struct('task', CAST(grp AS STRING), 'side', 0)) ELSE concat(
            transform(sequence(0, blocks[band] - 1), j -> named_struct(
                'task', concat_ws(':', grp, band, least(i, j), band, greatest(i, j)),
                'side', CASE WHEN i = j THEN 0 WHEN i < j THEN 1 ELSE 2 END)),
            transform(filter(sequence(0, coalesce(try_element_at(blocks, band + 1), 1) - 1),
                             j -> map_contains_key(blocks, band + 1)),
                      j -> named_struct('task', concat_ws(':', grp, band, i, band + 1, j), 'side', 1)),
            transform(filter(sequence(0, coalesce(try_element_at(blocks, band - 1), 1) - 1),
                             j -> map_contains_key(blocks, band - 1)),
                      j -> named_struct('task', concat_ws(':', grp, band - 1, j, band, i), 'side', 2))) END
    """
    return joined.withColumn("tasks", F.expr(tasks)).drop("__grp", "whole", "blocks", "i")


def tile_links(rows: DataFrame, link: Callable[[str, list[bytes], list[bytes] | None], np.ndarray]) -> DataFrame:
    """``id``, ``links`` (the weights of what it is linked to) and ``root`` from every task a member has links in.

    ``rows`` has ``id``, ``weight``, ``payload`` (binary) and ``tasks``.
    ``link`` gets a task's name and the payloads of its two blocks, or of one
    block and None, and gives the matrix of links between them.
    """
    spread = rows.select("id", "weight", "payload", F.inline("tasks"))
    # the name first brings a task's rows together, the sort puts them in a row
    sorted_rows = spread.repartition("task").sortWithinPartitions("task", "side", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in _tasks(batches):
            found = _linked(task, link)
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in found], names=["id", "links", "root"])

    return sorted_rows.select("task", "side", "id", "weight", "payload").mapInArrow(giving_back(run), "id long, links long, root long")


def tile_roots(members: DataFrame, connect: Callable[[np.ndarray, list[bytes]], np.ndarray], rows: int = ROOT_ROWS) -> DataFrame:
    """``id`` and ``root``: pairs that connect what ``connect`` connects in each group, without the pairs of a member with itself.

    ``members`` has ``grp``, ``n`` (members of the group, about), ``id``, ``size`` and ``payload``
    (binary). ``connect`` gets sizes and payloads of one block, or of two, and gives for each the
    place of one that it is connected with (its own if with none), the same for all that are connected.
    """
    blocks = F.ceil(F.col("n") / rows).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    task = ["grp", "low", "high"]
    spread = own.select("grp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "size", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, ([], [], [])
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in task], 1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), len(names)]
            columns = [batch.column(c).to_pylist() for c in ("id", "size", "payload")]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = tuple(names[a].tolist())
                if here != name:
                    found += connected(held)
                    name, held = here, ([], [], [])
                for mine, column in zip(held, columns, strict=True):
                    mine += column[a:b]
            yield pairs(found)
        yield pairs(connected(held))

    def connected(held: tuple[list, list, list]) -> list[np.ndarray]:
        ids = np.array(held[0], np.int64)
        if len(ids) < 2:
            return []
        root = ids[connect(np.array(held[1], np.int64), held[2])]
        apart = root != ids
        return [np.stack([ids[apart], root[apart]], 1)] if apart.any() else []

    def pairs(found: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in both.T], names=["id", "root"])

    return spread.repartition(*task).sortWithinPartitions(*task).mapInArrow(giving_back(run), "id long, root long")


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of one task after another; a task may go over the end of a batch."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("task").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and names[a] != name:
                yield held
                held = []
            held.append(batch.slice(a, b - a))
            name = names[a]
    if held:
        yield held


def _linked(task: list[pa.RecordBatch], link: Callable) -> tuple[np.ndarray, ...] | None:
    rows = pa.Table.from_batches(task)
    ids, side = rows.column("id").to_numpy(), rows.column("side").to_numpy()
    # a class whose row is repeated came more than once, and counts once
    new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (side[1:] != side[:-1])])
    rows = rows.filter(pa.array(new))
    side = rows.column("side").to_numpy()
    ids, weight = rows.column("id").to_numpy(), rows.column("weight").to_numpy()
    payload = rows.column("payload").to_pylist()
    name = task[0].column("task")[0].as_py()
    split = int(np.searchsorted(side, 2)) if side[0] == 1 else 0
    if side[0] == 0:
        if len(ids) < 2:
            return None
        matrix = link(name, payload, None)
        links = matrix @ weight
        i, j = np.nonzero(np.triu(matrix, 1))
    else:
        if not 0 < split < len(ids):
            return None
        matrix = link(name, payload[:split], payload[split:])
        links = np.concatenate([matrix @ weight[split:], weight[:split] @ matrix])
        i, j = np.nonzero(matrix)
        j = j + split
    if not len(i):
        return None
    root = _roots(len(ids), i, j)
    own = links > 0
    return ids[own], links[own], ids[root][own]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A member of its component for each of n members, the same for all of them."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low
