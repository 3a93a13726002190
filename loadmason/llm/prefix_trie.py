"""The trie of conversation prefixes: balanced parentheses per shard, shared spines merged.

1. Turns get their place from a range partitioning, so that no conversation is
   ordered in one task. Every ``BAND_TURNS`` turns of a conversation make a
   row: a path of 16-byte digests. Nearly all conversations are one row; of
   longer ones the trie is built band by band, the deepest first, whose totals
   are handed to the nodes above.
2. Equal paths become one row with their number, by an aggregation combined
   before its shuffle. The distinct paths are range partitioned in their
   order into shards.
3. A shard writes the trie of its paths as balanced parentheses and their
   excess. ``find_close`` searches blocks of minimal excess for the end of a
   subtree; the rank of leaf pairs ``()`` counts its leaves, and cumulative
   arrays over the opening parentheses give its conversations and savings.
4. Only the nodes that a shard shares with the one before or after it, the
   spines, are incomplete. They are merged by an aggregation. A node is owned
   by the first shard that has it, so that nothing is counted twice.

A node goes by a 128-bit hash of its turns and their depth. Turns are ordered
by ``turn`` (null first); those with the same number go by the MD5 of role and
text, equal rows are turns of their own. A null role or text is empty. Turns
without a conversation id belong to none. Other columns are not read. Without
conversations there are no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import park
from .text_arrays import mix

BAND_TURNS = 1024
# Bytes of paths in a shard, about.
SHARD_BYTES = 16 << 20
BLOCK = 64
GROUP, SHARED = 5, 9
_SALTS = (np.uint64(0x9E6C63D0876A9A35), np.uint64(0xC13FA9A902A6328F))


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 0, ``digest`` of role and text, and ``bytes`` of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    # the row number splits even equal turns over partitions
    order = ["conv_id", "turn", "digest", "row"]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id())
    rows = park(rows.select("conv_id", "digest", "bytes", "n"), "turns").withColumn("part", F.shiftright("n", 33))
    stretches = rows.groupBy("conv_id", "part").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.select("conv_id", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(stretches, ["conv_id", "part"]).select("conv_id", (F.col("n") + F.col("shift")).alias("place"), "digest", "bytes")


def rebuilt(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """The turns of the rebuilt conversations by ``depth`` (from 0), and for each conversation a row of depth -1.

    A conversation begins with as many turns of its group's first one as its
    own hash says, and goes on with its own turns after that many.
    """
    turns = park(numbered(conversations), "numbered")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.withColumns(
        {"head": F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared, "base": F.col("conv_id") - F.col("conv_id") % group}
    )
    # fewer than ``shared`` turns of each
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("place") < shared - 1)).groupBy("conv_id")
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("place", "digest", "bytes"))).alias("turns")).withColumnRenamed("conv_id", "base")
    # a head stands for its base in at most ``group`` conversations
    convs = convs.join(heads, "base", "left")
    given = F.slice(F.coalesce("turns", F.array().cast("array<struct<place: long, digest: string, bytes: long>>")), F.lit(1), F.col("head").cast("int"))
    convs = park(convs.withColumn("given", given).select("conv_id", "head", "given"), "conversations")
    first = convs.select("conv_id", F.inline("given")).withColumnRenamed("place", "depth")
    own = turns.join(convs.select("conv_id", "head", F.size("given").alias("n_given")), "conv_id").where("place >= head")
    own = own.select("conv_id", (F.col("place") - F.col("head") + F.col("n_given")).alias("depth"), "digest", "bytes")
    marks = convs.select("conv_id", F.lit(-1).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return first.unionByName(own).unionByName(marks)


def _chunks(turns: DataFrame, band_turns: int) -> DataFrame:
    """For each ``conv_id`` and ``band`` the ``path`` of digests, ``sizes``, the hash ``r1``, ``r2`` of all before it, ``x1``, ``x2`` with it, and ``last``."""
    banded = turns.withColumn("band", F.expr(f"greatest(depth, 0) div {band_turns}")).repartition("conv_id", "band")
    held = banded.groupBy("conv_id", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "digest", "bytes"))).alias("turns"))
    held = held.withColumn("turns", F.filter("turns", lambda t: t["depth"] >= 0))
    paths = held.select("conv_id", "band", F.unhex(F.array_join("turns.digest", "")).alias("path"), F.col("turns.bytes").alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = [np.frombuffer(p, np.uint64).reshape(-1, 2) for p in batch.column("path").to_pylist()]
            bands = batch.column("band").to_pylist()
            found = [tuple(np.bitwise_xor.reduce(h, axis=1)) for h in (_steps(p, b * band_turns) for p, b in zip(halves, bands, strict=True))]
            pair = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            arrays = [*batch.columns, pa.array(pair[:, 0]), pa.array(pair[:, 1])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "y1", "y2"])

    hashed = paths.mapInArrow(run, "conv_id long, band long, path binary, sizes array<long>, y1 long, y2 long")
    bands = Window.partitionBy("conv_id").orderBy("band")
    before = bands.rowsBetween(Window.unboundedPreceding, -1)
    hashed = hashed.withColumns(
        {**{f"r{i}": F.coalesce(F.bit_xor(f"y{i}").over(before), F.lit(0)) for i in (1, 2)}, "last": F.lead("band").over(bands).isNull()}
    )
    return hashed.select("conv_id", "band", "path", "sizes", "r1", "r2", "last", *[F.col(f"r{i}").bitwiseXOR(F.col(f"y{i}")).alias(f"x{i}") for i in (1, 2)])


def _steps(halves: np.ndarray, depth: int) -> np.ndarray:
    """What each turn adds to the two hashes of its path, for turns that follow ``depth`` others."""
    at = mix(np.arange(depth + 1, depth + 1 + len(halves), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.stack([mix(halves[:, i] ^ mix(at ^ _SALTS[i])) ^ mix(halves[:, 1 - i] + at) for i in (0, 1)])


class Parentheses:
    """A forest as balanced parentheses: ``bits`` (True opens), their excess, and minimal excesses of blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(np.where(bits, 1, -1)).astype(np.int32)
        self.opens = np.flatnonzero(bits)
        blocks = max(1, -(-len(bits) // BLOCK))
        # what is beyond the end is never the end of a subtree
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(bits)] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        self.leaves = 1 << (blocks - 1).bit_length()
        self.low = np.full(2 * self.leaves, np.iinfo(np.int32).max, np.int32)
        self.low[self.leaves : self.leaves + blocks] = self.blocks.min(1)
        for level in range(self.leaves.bit_length() - 2, -1, -1):
            a = 1 << level
            self.low[a : 2 * a] = np.minimum(self.low[2 * a : 4 * a : 2], self.low[2 * a + 1 : 4 * a : 2])
        # "()" is a leaf
        pair = np.zeros(len(bits), bool)
        pair[:-1] = bits[:-1] & ~bits[1:]
        self.leaf_rank = np.concatenate([[0], np.cumsum(pair)])

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Where the subtree of each opening parenthesis ends: the next place whose excess is one less."""
        out = [self._find_close(opens[i : i + 65536]) for i in range(0, len(opens), 65536)]
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def _find_close(self, opens: np.ndarray) -> np.ndarray:
        want = self.excess[opens]  # the first value below this one
        block = opens // BLOCK
        hit = (self.blocks[block] < want[:, None]) & (np.arange(BLOCK) > (opens % BLOCK)[:, None])
        found = hit.any(1)
        close = block * BLOCK + hit.argmax(1)
        rest = np.flatnonzero(~found)
        if len(rest):
            low, node = want[rest], block[rest] + self.leaves
            climbing = np.ones(len(rest), bool)
            while climbing.any():
                # a left child whose sibling goes low enough is left for it; all others go up
                turn = climbing & (node % 2 == 0)
                turn[turn] = self.low[node[turn] + 1] < low[turn]
                node = np.where(turn, node + 1, np.where(climbing, node // 2, node))
                climbing &= ~turn
            high = np.flatnonzero(node < self.leaves)
            while len(high):
                left = 2 * node[high]
                node[high] = np.where(self.low[left] < low[high], left, left + 1)
                high = high[node[high] < self.leaves]
            at = node - self.leaves
            close[rest] = at * BLOCK + (self.blocks[at] < low[:, None]).argmax(1)
        return close


_NODES = (
    "n1 long, n2 long, depth long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, open boolean, under_open boolean, top boolean"
)


def _band_nodes(rows: DataFrame, band: int, band_turns: int) -> DataFrame:
    """The nodes of one band, shard by shard; ``open`` ones are to be merged, ``top`` ones are the band's roots.

    ``rows`` has one row for each distinct path: ``r1``, ``r2``, ``path``, ``sizes``,
    ``n``, ``conv_id`` and the totals ``below_children``, ``below_leaves``, ``below_saved``.
    """
    rows = park(rows, "paths")
    total = rows.agg(F.sum(F.octet_length("path") + F.lit(64))).head()[0] or 0
    order = ["r1", "r2", "path"]
    dealt = rows.repartitionByRange(-(-total // SHARD_BYTES) or 1, *order).withColumn("shard", F.spark_partition_id())
    dealt = park(dealt, "shards")
    # the paths next to a shard, one or two for each
    key = F.struct(*order)
    ends = dealt.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    by_shard = Window.orderBy("shard")
    ends = ends.withColumns({"before": F.lag("high").over(by_shard), "after": F.lead("low").over(by_shard)})
    beside = ends.select("shard", F.lit(0).alias("kind"), "before.*").unionByName(ends.select("shard", F.lit(2).alias("kind"), "after.*"))
    both = dealt.withColumn("kind", F.lit(1)).unionByName(beside.where("path IS NOT NULL"), allowMissingColumns=True)
    in_order = both.repartition("shard").sortWithinPartitions("shard", "kind", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            shards = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and shards[a] != held[0].column("shard")[0].as_py():
                    yield _shard_nodes(pa.Table.from_batches(held), band * band_turns)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield _shard_nodes(pa.Table.from_batches(held), band * band_turns)

    return in_order.mapInArrow(run, _NODES)


def _shard_nodes(table: pa.Table, depth: int) -> pa.RecordBatch:
    """The nodes of a shard's paths, which come in order, with the paths beside them."""
    table = table.combine_chunks()
    kind = table.column("kind").to_numpy()
    paths = [np.frombuffer(p, np.uint64).reshape(-1, 2) for p in table.column("path").to_pylist()]
    roots = np.stack([table.column(c).to_numpy() for c in ("r1", "r2")], 1).view(np.uint64)
    lengths = np.array([len(p) for p in paths]) + 1  # nodes on each path, with its root
    common = _common(paths, roots, lengths)
    own = np.flatnonzero(kind == 1)
    first, last = int(own[0]), int(own[-1])
    left = int(common[first]) if first else 0
    right = int(common[last + 1]) if last + 1 < len(paths) else 0
    goes_on = right == lengths[last]  # the last path is the beginning of the next shard's first

    table = table.slice(first, len(own))
    paths, roots, lengths = paths[first : last + 1], roots[own], lengths[own]
    shared = common[own].copy()
    shared[0] = 0
    # closing what the path before has alone, then opening what this one adds
    closes = np.concatenate([[0], lengths[:-1] - shared[1:], lengths[-1:]])
    opens = np.concatenate([lengths - shared, [0]])
    bits = np.repeat(np.tile([False, True], len(opens)), np.stack([closes, opens], 1).ravel())
    tree = Parentheses(bits)
    close = tree.find_close(tree.opens)
    count = len(tree.opens)
    row = np.repeat(np.arange(len(paths)), opens[:-1])  # the first path with the node
    level = tree.excess[tree.opens] - 1  # turns below the root
    # subtrees as ranges of nodes in preorder
    end = np.concatenate([[0], np.cumsum(bits)])[close + 1]
    terminal = np.cumsum(opens[:-1]) - 1  # the deepest node of each path; it is new, as paths differ
    parent = np.full(count, -1)
    parent[1:] = _parents(level)[1:]

    hashes = np.concatenate([_path_hashes(p, r, depth)[n - o :] for p, r, n, o in zip(paths, roots, lengths.tolist(), opens[:-1].tolist(), strict=True)])
    sizes = _last_sizes(table, lengths, opens[:-1])

    def column(name: str) -> np.ndarray:
        return table.column(name).to_numpy()

    on_first = np.zeros(count, bool)
    on_first[: lengths[0]] = True  # the first path is the first nodes in preorder
    merged = on_first & (level < left)
    owned = ~merged
    on_last = np.zeros(count, bool)
    node = int(terminal[-1])
    while node >= 0:
        on_last[node] = level[node] < right
        node = int(parent[node])

    def spread(values: np.ndarray) -> np.ndarray:
        out = np.zeros(count, np.int64)
        out[terminal] = values
        return out

    def below(values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, from cumulative sums in preorder."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[:-1]

    children, leaves, saved = (spread(column(f"below_{c}")) for c in ("children", "leaves", "saved"))
    n = below(spread(column("n")))
    pairs = tree.leaf_rank[close + 1] - tree.leaf_rank[tree.opens]
    # leaf pairs that are no leaves, as deeper turns follow them
    ends = close == tree.opens + 1
    inner = ends & (children > 0)
    if goes_on:
        inner[terminal[-1]] = ends[terminal[-1]]
    n_leaves = pairs + below(leaves - inner)
    child = np.flatnonzero(owned & (parent >= 0))
    n_children = children + np.bincount(parent[child], minlength=count)
    total = below(saved + n * sizes - np.where(owned, sizes, 0))
    least = np.full(count, np.iinfo(np.int64).max)
    least[terminal] = column("conv_id")
    for d in range(int(level.max()), 0, -1):
        deep = np.flatnonzero(level == d)
        np.minimum.at(least, parent[deep], least[deep])

    top = (level == 0) & (depth > 0)
    unfinished = merged | on_last | top
    p = np.maximum(parent, 0)
    has = parent >= 0
    signed = hashes.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed[:, 0]), pa.array(signed[:, 1]), pa.array(depth + level, pa.int64()),
            pa.array(signed[p, 0], mask=~has), pa.array(signed[p, 1], mask=~has), pa.array(least), pa.array(least[p], mask=~has),
            pa.array(n), pa.array(n_children.astype(np.int64)), pa.array(n_leaves), pa.array(total),
            pa.array(unfinished), pa.array(unfinished[p] & has), pa.array(top),
        ],
        names=[c.split()[0] for c in _NODES.split(", ")],
    )


def _common(paths: list[np.ndarray], roots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many nodes each path shares with the one before it."""
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] - 1)])
    turns = np.concatenate(paths)
    out = np.zeros(len(paths), np.int64)
    active = np.flatnonzero((roots[1:] == roots[:-1]).all(1)) + 1
    out[active] = 1
    while len(active):
        at = out[active] - 1
        active, at = (x[at < np.minimum(lengths[active], lengths[active - 1]) - 1] for x in (active, at))
        same = (turns[starts[active] + at] == turns[starts[active - 1] + at]).all(1)
        active = active[same]
        out[active] += 1
    return out


def _parents(level: np.ndarray) -> np.ndarray:
    """The parent of each node in preorder: the last one before it that is a level higher."""
    out = np.full(len(level), -1)
    held = np.full(int(level.max()) + 2, -1)
    for i, d in enumerate(level.tolist()):
        out[i] = held[d - 1] if d else -1
        held[d] = i
    return out


def _path_hashes(path: np.ndarray, root: np.ndarray, depth: int) -> np.ndarray:
    """The hashes of the nodes of a path, from its root on."""
    steps = np.concatenate([root[:, None], _steps(path, depth)], 1)
    return np.bitwise_xor.accumulate(steps, axis=1).T


def _last_sizes(table: pa.Table, lengths: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The bytes of each new node's turn; a root has none here."""
    flat = np.concatenate([np.empty(0, np.int64), *[c.flatten().to_numpy(zero_copy_only=False) for c in table.column("sizes").chunks]]).astype(np.int64)
    # a zero in front of each path's sizes stands for its root
    starts = np.cumsum(lengths) - lengths
    with_roots = np.zeros(int(lengths.sum()), np.int64)
    keep = np.ones(len(with_roots), bool)
    keep[starts] = False
    with_roots[keep] = flat
    first_new = starts + lengths - opens
    index = np.repeat(first_new - (np.cumsum(opens) - opens), opens) + np.arange(int(opens.sum()))
    return with_roots[index]


_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED, band_turns: int = BAND_TURNS) -> tuple[DataFrame, DataFrame]:
    """The nodes (``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, and
    their hash ``n1``, ``n2``), and for each conversation the node at which it ends (``n1``, ``n2``, ``conv_id``)."""
    chunks = park(_chunks(rebuilt(conversations, group, shared), band_turns), "chunks")
    deepest = chunks.agg(F.max("band")).head()[0]
    below, parts = None, []
    for band in range(-1 if deepest is None else deepest, -1, -1):
        classes = chunks.where(F.col("band") == band).groupBy("r1", "r2", "path").agg(
            F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("sizes").alias("sizes"),
            F.any_value("x1").alias("x1"), F.any_value("x2").alias("x2"),
        )
        totals = ["below_children", "below_leaves", "below_saved"]
        if below is None:
            classes = classes.withColumns({c: F.lit(0).cast("long") for c in totals})
        else:
            classes = classes.join(below, ["x1", "x2"], "left").fillna(0, totals)
        nodes = park(_band_nodes(classes.drop("x1", "x2"), band, band_turns), "nodes")
        tops = nodes.where("top").groupBy(F.col("n1").alias("x1"), F.col("n2").alias("x2"))
        below = tops.agg(*[F.sum(c).alias(t) for c, t in zip(_SUMS[1:], totals, strict=True)])
        below = park(below, "below")
        # the nodes at a band's lower edge are parents in the next one
        parts.append(nodes.where("NOT top").withColumn("edge", F.col("depth") == (band + 1) * band_turns))
    if not parts:
        empty = conversations.sparkSession.createDataFrame([], _NODES).select("conv_id", "depth", "parent_conv_id", *_SUMS, "n1", "n2")
        return empty, chunks.select(F.col("x1").alias("n1"), F.col("x2").alias("n2"), "conv_id")

    nodes = reduce(DataFrame.unionByName, parts)
    spines = nodes.where("open").groupBy("n1", "n2", "depth").agg(
        F.any_value("p1").alias("p1"), F.any_value("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in _SUMS], F.max("under_open").alias("under_open"), F.max("parent_conv_id").alias("parent_conv_id"),
        F.max("edge").alias("edge"),
    )
    spines = park(spines, "spines")
    whole = nodes.where("NOT open").drop("open", "top").unionByName(spines)
    open_parents = spines.select("n1", "n2", "conv_id").unionByName(nodes.where("NOT open AND edge").select("n1", "n2", "conv_id"))
    open_parents = open_parents.toDF("p1", "p2", "parent")
    # a parent that other shards have too is known only now
    named = whole.where("under_open").join(park(open_parents, "open-parents"), ["p1", "p2"]).withColumn("parent_conv_id", F.col("parent")).drop("parent")
    found = whole.where("NOT under_open").unionByName(named)
    ends = chunks.where("last").select(F.col("x1").alias("n1"), F.col("x2").alias("n2"), "conv_id")
    return found.select("conv_id", "depth", "parent_conv_id", *_SUMS, "n1", "n2"), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """For each node the SHA-256 of the ids of the conversations that end there, ascending and joined by commas.

    The ids stream through one digest a node; none are collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, digest = None, None
        for batch in batches:
            rows: list[tuple] = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "conv_id")), strict=True):
                if key != name:
                    if name:
                        rows.append((*name, digest.hexdigest()))
                    name, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["n1", "n2", "ends_sha256"])
        if name:
            yield pa.RecordBatch.from_pydict({"n1": [name[0]], "n2": [name[1]], "ends_sha256": [digest.hexdigest()]})

    sorted_rows = ends.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "conv_id")
    return sorted_rows.mapInArrow(run, "n1 long, n2 long, ends_sha256 string")


def trie_digests(conversations: DataFrame, **options) -> DataFrame:
    """The nodes with ``ends_sha256``; of no ids it is that of an empty text."""
    nodes, ends = trie(conversations, **options)
    return nodes.join(end_digests(ends), ["n1", "n2"], "left").fillna(hashlib.sha256(b"").hexdigest(), ["ends_sha256"]).drop("n1", "n2")

