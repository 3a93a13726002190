"""Packing documents into sequences: first fit decreasing over a tournament tree of bin capacities.

Documents become pieces of at most ``length`` ids: whole lengths, then the
rest. Pieces are dealt at random into groups of about ``group_pieces``, and
each group is packed on its own: the longest piece first, each into the first
bin that still has room. The tree holds in each node the largest room below
it, so that bin is found in as many steps as the tree is high.

A null text is an empty document: the end id alone. Rows that share an id are
packed as documents of their own. An empty table gives no pieces. The group is
drawn from a row number, not from the id, so no id can fill a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, park, text_slices
from .units import encode_whole, tokenizer_store

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LENGTH = 4096
GROUP_PIECES = 8192

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def cut_pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """The pieces of each document's ids: where they start, how many, and the ids themselves.

    Documents are encoded whole; the pieces are cut from their ids.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = tokenizer_store(path)
        for batch, texts in text_slices(batches):
            encoded = encode_whole(texts, store)
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    rows.append((doc, start, len(piece), piece.tobytes(), len(ids)))
            kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


class Bins:
    """Bins of equal capacity, as many as are needed; each piece goes into the first that has room."""

    def __init__(self, capacity: int, leaves: int = 1):
        self.capacity, self.leaves = capacity, leaves
        self.room = [capacity] * (2 * leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Bin and offset of a piece."""
        while self.room[1] < size:
            self._grow()
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        found = node - self.leaves, self.capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return found

    def _grow(self) -> None:
        """Twice as many bins: the tree becomes the left half of a larger one."""
        room = [self.capacity] * (4 * self.leaves)
        width = 1
        while width <= self.leaves:
            room[2 * width : 3 * width] = self.room[width : 2 * width]
            width *= 2
        self.room, self.leaves = room, 2 * self.leaves


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; the pieces come in decreasing order of length."""
    bins = Bins(capacity)
    places = np.array([bins.place(size) for size in lengths.tolist()], "i8").reshape(-1, 2)
    return places[:, 0], places[:, 1]


def pack(pieces: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """The pieces and their ids with ``sequence_id``, their ``offset`` in it, and ``ids_crc32`` of the ids given out."""
    numbered = park(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-numbered.count() // group_pieces))
    dealt = numbered.withColumn("__group", F.pmod(F.xxhash64(F.lit(seed), "__row"), F.lit(groups)))
    # the longest piece of a group first, so that each finds its place when it comes
    in_order = dealt.repartition("__group").sortWithinPartitions("__group", F.desc("length"), "__row")
    kept = pieces.columns

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, current = Bins(length), None
        for batch in batches:
            sequences, offsets = [], []
            for group, size in zip(batch.column("__group").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if group != current:
                    bins, current = Bins(length), group
                number, offset = bins.place(size)
                sequences.append((group << 32) + number)
                offsets.append(offset)
            places = [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *places], names=[*kept, "sequence_id", "offset"])

    placed = in_order.mapInArrow(giving_back(fill), f"{_PIECES}, sequence_id long, offset long")
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, their ``ids`` one after another, and the ``offsets`` and ``doc_ids`` of the pieces."""
    piece = F.struct("offset", "doc_id", F.hex("ids").alias("ids"))
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    ids = F.unhex(F.array_join("pieces.ids", ""))
    return held.select("sequence_id", ids.alias("ids"), F.col("pieces.offset").alias("offsets"), F.col("pieces.doc_id").alias("doc_ids"))


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Packs whole documents into sequences of at most ``length`` ids."""
    return pack(cut_pieces(docs, path, end_id, length), length)
