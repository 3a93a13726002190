"""Which owners share a key, for very many keys of which few are shared.

Keys are 64-bit hashes. Slices of about a million keys are sorted where they
are; each key is kept once with its smallest owner (owners that share it
within the slice give their links at once) and dealt by its value into
buckets, as differences of sorted numbers. A bucket, wherever Spark sends it,
links the owners of each key to the smallest of them. So a key is shuffled
once, in eight or nine bytes, and a key that everything shares is one entry a
slice. The number of buckets grows with the keys. Owners that share many keys
are one group, not one for each key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import giving_back, park

SLICE_KEYS = 1 << 20
# A slice numbers its owners in 16 bits.
SLICE_OWNERS = 1 << 16
BUCKET_KEYS = 1 << 20

_DEALT = "bucket long, keys binary, owners binary, least binary"
# Bits of a bitmap row, as Spark's own bitmaps have them, and of the largest filter (32 MB).
ROW_BITS = 1 << 15
MOST_BITS = 1 << 28


def narrow(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences of as few bytes as the largest one needs."""
    steps = np.diff(keys)
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return bytes([width]) + keys[:1].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def wide(data: bytes) -> np.ndarray:
    width, first = data[0], np.frombuffer(data, np.uint64, 1, 1)
    steps = np.zeros(((len(data) - 9) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(np.concatenate([first, steps.view(np.uint64).ravel()]), dtype=np.uint64)


def _links(keys: np.ndarray, owner: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each owner of a key but the smallest, that one, and the key; the keys come sorted with their owners, and start at ``first``."""
    least = np.repeat(owner[first], np.diff([*first.tolist(), len(keys)]))
    apart = owner != least
    apart[1:] &= (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return owner[apart], least[apart], keys[apart].view(np.int64)


def _dealt(owners: np.ndarray, keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[list]:
    """A slice's keys by bucket, and last (bucket null) the links within it and their keys."""
    names, index = np.unique(owners, return_inverse=True)
    by_key = np.repeat(index.astype(np.uint16), counts)
    order = np.lexsort((by_key, keys))
    keys, owner = keys[order], by_key[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    within = _links(keys, names[owner], first) if len(first) < len(keys) else None
    keys, owner = keys[first], owner[first]
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        used, least = np.unique(owner[a:b], return_inverse=True)
        yield [int(bucket[a]), narrow(keys[a:b]), names[used].tobytes(), least.astype(np.uint16).tobytes()]
    if within is not None and len(within[0]):
        yield [None, within[2].tobytes(), within[0].tobytes(), within[1].tobytes()]


def shared_key_links(rows: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``key``: pairs of owners, a larger and a smaller one, through which all owners of each key are connected.
    Every owner of a shared key but its smallest is an ``a`` of it, and the smallest ``b`` of a key is that one.
    A pair comes up at most once for each key in each bucket and slice.

    ``rows`` has ``owner`` (long) and ``keys`` (array of longs); an owner may have several rows.
    """
    total = rows.agg(F.sum(F.size("keys").cast("long"))).head()[0] or 0
    buckets = -(-total // BUCKET_KEYS) or 1
    names = [c.split()[0] for c in _DEALT.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_keys, n_rows = [], 0, 0
        for batch in batches:
            lists = batch.column("keys")
            counts = np.diff(lists.offsets.to_numpy())
            held.append((batch.column("owner").to_numpy(), lists.flatten().to_numpy().view(np.uint64), counts))
            n_keys, n_rows = n_keys + len(held[-1][1]), n_rows + len(counts)
            if n_keys >= SLICE_KEYS or n_rows > SLICE_OWNERS // 2:
                yield from slices(held)
                held, n_keys, n_rows = [], 0, 0
        yield from slices(held)

    def slices(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        owners, keys, counts = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()  # the arrays now hold all of it
        ends = np.concatenate([[0], np.cumsum(counts)])
        for a in range(0, len(owners), SLICE_OWNERS):
            b = min(a + SLICE_OWNERS, len(owners))
            if ends[b] > ends[a]:
                for row in _dealt(owners[a:b], keys[ends[a] : ends[b]], counts[a:b], buckets):
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield _bucket_links(held)
                    held = []
                if row["bucket"] is None:
                    pair = [np.frombuffer(row[c], np.int64) for c in ("owners", "least", "keys")]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in pair], names=["a", "b", "key"])
                else:
                    held.append(row)
        if held:
            yield _bucket_links(held)

    dealt = rows.select("owner", "keys").mapInArrow(giving_back(deal), _DEALT)
    # links within slices go anywhere
    spread = F.coalesce("bucket", F.pmod(F.xxhash64("owners"), F.lit(buckets)))
    in_order = dealt.repartition(spread).sortWithinPartitions("bucket")
    return in_order.mapInArrow(giving_back(link), "a long, b long, key long")


def _bucket_links(rows: list[dict]) -> pa.RecordBatch:
    keys = np.concatenate([wide(r["keys"]) for r in rows])
    owner = np.concatenate([np.frombuffer(r["owners"], np.int64)[np.frombuffer(r["least"], np.uint16)] for r in rows])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    several = order[same[1:] | same[:-1]]
    k, o = keys[several], owner[several]
    order = np.lexsort((o, k))
    k, o = k[order], o[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in _links(k, o, first)], names=["a", "b", "key"])


def owner_groups(links: DataFrame) -> DataFrame:
    """``grp``, ``owner`` and ``n``: the different sets of owners that share a key, each once, whatever the number of keys they share.

    ``links`` is what ``shared_key_links`` gives, written out, so that Spark can split the
    part of a key with very many owners. ``n`` is the number of owners; some may be counted twice.
    """
    # sums of 33 bits, which very many rows do not overflow
    sums = [F.sum(F.shiftright(F.xxhash64(F.lit(salt), "a"), 31)).alias(f"s{salt}") for salt in (1, 2)]
    by_key = links.groupBy("key").agg(*sums, F.min("b").alias("least"), (F.count(F.lit(1)) + 1).alias("n"))
    groups = park(by_key.groupBy("s1", "s2", "least", "n").agg(F.min("key").alias("grp")).select("grp", "least", "n"), "owner-groups")
    others = links.join(groups, links["key"] == groups["grp"]).select("grp", F.col("a").alias("owner"), "n")
    return others.unionByName(groups.select("grp", F.col("least").alias("owner"), "n"))


class KeyFilter:
    """A filter of one bit for each listed key, at most 32 MB of them: what it lets through may be listed, the rest is not.

    Its rows of 4 kB are broadcast, so that rows of a large table that cannot
    match are kept out of a shuffle. Beyond the largest size more of them pass.
    """

    def __init__(self, keys: DataFrame, name: str):
        (column,) = keys.columns
        n = keys.count()
        self.bits = min(MOST_BITS, max(ROW_BITS, 1 << (32 * n).bit_length()))
        at = self._at(F.col(column))
        placed = keys.select(at.alias("at")).groupBy((F.col("at") / ROW_BITS).cast("long").alias("row"))
        self.rows = park(placed.agg(F.bitmap_construct_agg(F.col("at") % ROW_BITS).alias("bitmap")), name)

    def _at(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(17), key), F.lit(self.bits))

    def split(self, df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """The rows whose key may be listed, and those whose key is not."""
        at, row, bitmap = free_names(df, "at", "row", "bitmap")
        placed = df.withColumn(at, self._at(key))
        rows = self.rows.select(F.col("row").alias(row), F.col("bitmap").alias(bitmap))
        found = placed.join(F.broadcast(rows), (F.col(at) / ROW_BITS).cast("long") == F.col(row), "left")
        place = (F.col(at) % ROW_BITS).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))
        return found.where(hit).drop(at, row, bitmap), found.where(~hit).drop(at, row, bitmap)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of the frame has, whatever case it is written in."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out
