"""Jaccard self-join of documents over word shingles, exact.

1. Documents with equal shingle sets become one class, whatever their number.
   A class goes by a number of its own, as one ``doc_id`` may hold several texts.
2. Size bands and hashed parts find candidates. Two sets whose smaller one has
   ``a`` shingles and whose similarity reaches ``num / den`` differ in at most
   ``a * (den - num) / num`` shingles. Cut by hash into more parts than that,
   they must be equal in one. Each class gives a key for every part (in its own
   band, and in the lower ones where a partner may be the smaller set), and
   classes that share a key are candidates. A third of all documents holding
   the same passage does not make a hot key: a key stands for all that a
   document has in a part.
3. Documents with a passage in common share keys too, and through them most
   documents would be connected. So the classes of each different group that
   shares keys are held against each other by bitmaps of a bit or two for each
   shingle, and only those that may reach the threshold stay connected.
4. Connected candidates are compared in size-banded tiles: hashed bitmaps
   bound every pair's overlap from above by their bit counts, and pairs that
   may reach the threshold are decided by intersecting their sorted arrays.
   Large groups are cut into blocks, and no task gives out pairs.

Empty parts are equal in unrelated sets. So there are a few more parts than
needed: that many parts may be empty and still another one is equal. Only a set
with more empty parts than that gives keys for its empty ones.

Null and empty texts, and texts of white space, have no shingles and are linked
with nothing. A text with fewer words than a shingle is one shingle. Rows with
the same ``doc_id`` count as one document that has the links of all of them,
also where their texts differ (each has its own size); rows whose ``doc_id`` is null get a size and nothing else. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classes import grouped, groups_of_rows
from .common import park, quoted, release, text_slices
from .components import components
from .shared_keys import KeyFilter, free_names, owner_groups, shared_key_links
from .text_arrays import TextArrays, mix
from .tiles import tile_links, tile_roots, tile_tasks

SIZE, NUM, DEN = 3, 9, 10
# Each size band reaches this many times as far as the one before, less one step at least.
BAND_RATIO = 1.25
# At most this share of sets of a band should have more empty parts than are allowed for.
EMPTY_SHARE = 1e-3
# Bits of the largest bitmap of a candidate; larger sets have fewer than one for each shingle.
SKETCH_BITS = 1 << 15

_SUM1, _SUM2, _PART = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D)
_BAND, _PLACE = np.uint64(0xD1342543DE82EF95), np.uint64(0x9FB21C651E98DF25)


_PLANS: dict[tuple[int, int, int], tuple[int, int]] = {}


def _edges() -> np.ndarray:
    """The smallest size of each band, up to sizes that no text has."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
    return np.array(edges, np.int64)


EDGES = _edges()


def band_parts(band: int, num: int, den: int) -> tuple[int, int]:
    """The number of parts of a band, and how many of them may be empty; no parts where only equal sets can link."""
    if (band, num, den) not in _PLANS:
        _PLANS[band, num, den] = _plan(int(EDGES[band]), int(EDGES[band + 1]) - 1, num, den)
    return _PLANS[band, num, den]


def _plan(low: int, top: int, num: int, den: int) -> tuple[int, int]:
    differ = top * (den - num) // num
    if not differ:
        return 0, 0
    best = (2.0, 0)
    for spare in range(differ + 1):
        parts = differ + 1 + spare
        expected = parts * math.exp(-low / parts)
        term = total = math.exp(-expected)
        for i in range(1, spare + 1):
            term *= expected / i
            total += term
        best = min(best, (1 - total, spare))
        if 1 - total <= EMPTY_SHARE:
            break
    return differ + 1 + best[1], best[1]


def part_keys(sets: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sorted sets, and each key's set."""
    sizes = np.diff(bounds)
    high = np.searchsorted(EDGES, sizes, "right") - 1
    low = np.searchsorted(EDGES, np.maximum(1, -(-num * sizes // den)), "right") - 1
    keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for down in range(int((high - low).max(initial=0)) + 1):
        band = high - down
        plan = [band_parts(int(b), num, den) if b >= 0 else (0, 0) for b in range(int(band.max(initial=0)) + 1)]
        parts = np.array([p for p, _ in plan], np.int64)[np.maximum(band, 0)]
        spare = np.array([s for _, s in plan], np.int64)[np.maximum(band, 0)]
        chosen = (band >= low) & (sizes > 0) & (parts > 0)
        if not chosen.any():
            continue
        doc = np.repeat(np.arange(len(sizes)), sizes)
        mine = chosen[doc]
        doc, values = doc[mine], sets[mine]
        part = ((values >> np.uint64(32)) * parts[doc].astype(np.uint64)) >> np.uint64(32)
        # the sets are sorted, so a part's shingles lie together
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])]))
        sums = np.add.reduceat(mix(values ^ _PART), first)
        keys.append(_key(band[doc[first]], part[first], sums))
        owners.append(doc[first])
        filled = np.bincount(doc[first], minlength=len(sizes))
        for d in np.flatnonzero(chosen & (parts - filled > spare)).tolist():
            empty = np.setdiff1d(np.arange(parts[d], dtype=np.uint64), part[first][doc[first] == d])
            keys.append(_key(np.full(len(empty), band[d]), empty, np.zeros(len(empty), np.uint64)))
            owners.append(np.full(len(empty), d))
    return np.concatenate(keys), np.concatenate(owners)


def _key(band: np.ndarray, part: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return mix(sums + mix((band.astype(np.uint64) + np.uint64(1)) * _BAND + (part + np.uint64(1)) * _PLACE))


def shingle_sets(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``doc_id``, a 128-bit hash of the text, ``n_shingles``, one of the set (null if empty), the keys of its parts and its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets, bounds = TextArrays(texts, lower=True).shingles(size)
            keys, owners = part_keys(sets, bounds, num, den)
            order = np.argsort(owners, kind="stable")
            offsets = np.searchsorted(owners[order], np.arange(len(texts) + 1)).astype(np.int32)
            empty = np.diff(bounds) == 0
            arrays = [
                *[batch.column(name) for name in ("doc_id", "t1", "t2")],
                pa.array(np.diff(bounds), pa.int64()),
                *[pa.array(h.view(np.int64), pa.int64(), mask=empty) for h in _set_hashes(sets, bounds)],
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[order].view(np.int64))),
                pa.array([sketch(sets[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "t1", "t2", "n_shingles", "h1", "h2", "keys", "sketch"])

    schema = "doc_id long, t1 long, t2 long, n_shingles long, h1 long, h2 long, keys array<long>, sketch binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_hashes()).mapInArrow(run, schema)


def _text_hashes() -> list[Column]:
    return [F.xxhash64(F.lit(salt), "text").alias(f"t{salt}") for salt in (1, 2)]


def _set_hashes(sets: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    out = []
    for salt in (_SUM1, _SUM2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ salt))])
        out.append(sums[bounds[1:]] - sums[bounds[:-1]])
    return out


def jaccard_join(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest linked id, over any number of links) and ``n_links``.

    Two documents link when ``den * intersection >= num * union`` of their shingle sets.
    """
    sets, by_class = _linked_classes(docs, size, num, den)
    by_class = park(by_class.select("h1", "h2", F.col("first.doc_id").alias("component_id"), "n_links"), "classes-found")
    rows = sets.select(F.col("doc_id").alias("id"), "n_shingles", "h1", "h2")
    return groups_of_rows(rows, by_class).select(
        F.col("id").alias("doc_id"), "n_shingles",
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
        "n_links",
    )


def _linked_classes(docs: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The sets, and their classes (``h1``, ``h2``) with ``n_links`` and ``first``: the smallest document that links lead to, by its id and the hash of its text."""
    sets = shingle_sets(docs, size, num, den).withColumn("row", F.monotonically_increasing_id())
    keyed = park(sets, "part-keys")
    sets = park(keyed.drop("keys", "sketch"), "shingle-sets")
    some = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    known = sets.where(some)
    # a class is numbered by its first row, as ids may repeat with other texts
    classes = known.groupBy("n_shingles", "h1", "h2")
    # a group is connected through its smallest member; its pairs are never written
    links = park(shared_key_links(keyed.where(some).select(F.col("h1").alias("owner"), "keys")), "shared-keys")
    # half the hash of a set tells the candidates apart; the other half decides what is equal
    sketches = keyed.where(some).select(F.col("h1").alias("id"), F.col("n_shingles").alias("size"), F.col("sketch").alias("payload"))
    sketches = park(sketches.distinct(), "sketches")
    release(keyed)
    near = park(_near(links, sketches, num, den), "near")
    release(links, sketches)
    candidates = park(components(near), "candidates")
    release(near)

    least = F.min(F.struct("doc_id", "t1", "t2")).alias("least")
    sized = park(classes.agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("weight"), least), "classes")
    linked = park(_compared(docs, sized, candidates, size, num, den), "links")
    return sets, grouped(sized, linked)


def _near(links: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that connect the candidates whose bitmaps allow a link, in every group that shares keys."""
    members = park(owner_groups(links).withColumnRenamed("owner", "id"), "group-members")
    return tile_roots(members.join(sketches, "id"), lambda sizes, maps: near_roots(sizes, maps, num, den))


def _compared(docs: DataFrame, sized: DataFrame, candidates: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """The links among connected candidates."""
    # sizes of linked sets are at most one band of this ratio apart
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(den / num * 1.000001)).cast("int")
    members = candidates.withColumnRenamed("id", "h1").join(sized, "h1").select(
        "id", F.col("component").alias("grp"), band.alias("band"), (8 * F.col("n_shingles")).alias("bytes"), "weight", "h1", "least"
    )
    tasks = tile_tasks(members).select("id", "weight", "h1", "tasks", "least.*")
    # the text of a class is that of its smallest document, which is in no other class
    tasks = park(tasks, "tile-tasks")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_text_hashes())
    # texts that are compared with none are not shuffled
    texts, _ = KeyFilter(tasks.select("t1"), "compared").split(texts, F.col("t1"))
    chosen = texts.join(tasks.hint("shuffle_hash"), ["doc_id", "t1", "t2"]).select("id", "text", "weight", "h1", "tasks")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            values, bounds = TextArrays(texts, lower=True).shingles(size)
            payload = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            same = _set_hashes(values, bounds)[0].view(np.int64) == batch.column("h1").to_numpy()
            columns = [batch.column("id"), batch.column("weight"), pa.array(payload, pa.binary()), batch.column("tasks")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "weight", "payload", "tasks"]).filter(pa.array(same))

    schema = "id long, weight long, payload binary, tasks array<struct<task: string, side: int>>"
    # the rows of one document that is repeated with the same text are one member in each tile
    rows = chosen.mapInArrow(sets, schema)

    def link(_: str, left: list[bytes], right: list[bytes] | None) -> np.ndarray:
        return overlaps(left, right, num, den)

    return tile_links(rows, link)


def overlaps(left: list[bytes], right: list[bytes] | None, num: int, den: int) -> np.ndarray:
    """The matrix of links between two blocks of sorted sets, or within one block."""
    a = [np.frombuffer(x, np.uint64) for x in left]
    b = a if right is None else [np.frombuffer(x, np.uint64) for x in right]
    longest = max(map(len, a + b))
    bits = min(1 << 16, max(256, 1 << (2 * longest - 1).bit_length()))
    a_bits = bitmaps(a, bits)
    b_bits = a_bits if right is None else bitmaps(b, bits)
    sizes = np.array([len(x) for x in b])
    matrix = np.zeros((len(a), len(b)), bool)
    for i, one in enumerate(a):
        start = i + 1 if right is None else 0
        total = len(one) + sizes[start:]
        need = -(-num * total // (num + den))
        # a bit that only one side has is a shingle that only it has
        only_a = np.bitwise_count(a_bits[i] & ~b_bits[start:]).sum(1, dtype=np.int64)
        only_b = np.bitwise_count(~a_bits[i] & b_bits[start:]).sum(1, dtype=np.int64)
        may = np.flatnonzero(np.minimum(len(one) - only_a, sizes[start:] - only_b) >= need)
        if len(may):
            matrix[i, start + may] = _shared(one, [b[start + j] for j in may.tolist()]) >= need[may]
    return matrix | matrix.T if right is None else matrix


def sketch(one: np.ndarray) -> bytes:
    """The bitmap of a set, with a bit or two for each shingle."""
    return bitmaps([one], min(SKETCH_BITS, max(64, 1 << (len(one) - 1).bit_length()))).tobytes()


def near_roots(sizes: np.ndarray, sketches: list[bytes], num: int, den: int) -> np.ndarray:
    """For each set the first one of those that it is connected with by pairs whose bitmaps allow a link."""
    words = min(map(len, sketches)) // 8
    # a larger bitmap folded over is the one with fewer bits
    maps = np.stack([np.bitwise_or.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0) for x in sketches])
    roots = np.arange(len(sizes))
    left = roots.copy()
    while len(left) > 1:
        first, left = int(left[0]), left[1:]
        queue = [first]
        while queue and len(left):
            one = queue.pop()
            rest = maps[left]
            # a bit that only one side has is a shingle that only it has
            only_one = np.bitwise_count(maps[one] & ~rest).sum(1, dtype=np.int64)
            only_rest = np.bitwise_count(~maps[one] & rest).sum(1, dtype=np.int64)
            need = -(-num * (sizes[one] + sizes[left]) // (num + den))
            may = np.minimum(sizes[one] - only_one, sizes[left] - only_rest) >= need
            queue += left[may].tolist()
            roots[left[may]] = first
            left = left[~may]
    return roots


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    packed = np.empty((len(sets), bits // 8), np.uint8)
    for row, one in zip(packed, sets, strict=True):
        flags = np.zeros(bits, bool)
        flags[(one & np.uint64(bits - 1)).astype(np.int64)] = True
        row[:] = np.packbits(flags)
    return packed.view(np.uint64)


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values of a sorted set each of the others shares."""
    joined = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    first = np.cumsum([0, *(len(x) for x in others[:-1])])
    return np.add.reduceat(one[place] == joined, first, dtype=np.int64)


def keep_one(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The documents with one of each group of linked ones: the smallest id. All columns stay.

    Rows that repeat an id are each judged by their own text: only those whose set is equal to or
    linked with that of a row that stays are deleted. Where such rows have the smallest id too, the
    text with the smallest hash stays. Of rows that have both id and text in common one stays.
    """
    sets, by_class = _linked_classes(docs, size, num, den)
    by_class = park(by_class.select("h1", "h2", "first"), "groups")
    classed = sets.where(F.col("doc_id").isNotNull()).join(by_class, ["h1", "h2"])
    later = classed.where(F.struct("doc_id", "t1", "t2") != F.col("first")).select("doc_id", "t1", "t2").distinct()
    repeated = sets.groupBy("doc_id", "t1", "t2").count().where("count > 1").select("doc_id", "t1", "t2")
    gone, again = F.lit(True).alias("gone"), F.lit(False).alias("gone")
    judged = park(later.select("*", gone).unionByName(repeated.select("*", again)).groupBy("doc_id", "t1", "t2").agg(F.max("gone").alias("gone")), "judged")
    names = free_names(docs, "id_of", "t1_of", "t2_of", "gone_of", "row_of")
    own, t1, t2, verdict, row = names
    keyed = docs.withColumns({own: F.col("doc_id").cast("long"), t1: _text_hashes()[0], t2: _text_hashes()[1]})
    # only what may be judged meets the judgements; all other rows stay where they are
    some, rest = KeyFilter(judged.select("t1"), "judged-texts").split(keyed, F.col(t1))
    listed = judged.toDF(*(f"{c}r" for c in names[:3]), verdict).hint("shuffle_hash")
    same = F.col(own).eqNullSafe(F.col(f"{own}r")) & (F.col(t1) == F.col(f"{t1}r")) & (F.col(t2) == F.col(f"{t2}r"))
    met = some.join(listed, same, "left").drop(*(f"{c}r" for c in names[:3]))
    untouched = met.where(F.col(verdict).isNull()).select(*map(quoted, docs.columns))
    # rows of one id and text, which may hold columns that cannot be compared
    once = met.where(~F.col(verdict)).select(own, t1, t2, F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(row))
    once = once.groupBy(own, t1, t2).agg(F.any_value(row).alias(row)).select(f"{row}.*")
    return rest.select(*map(quoted, docs.columns)).unionByName(untouched).unionByName(once)
