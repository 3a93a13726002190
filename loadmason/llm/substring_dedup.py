"""Removing passages that an earlier document holds: Rabin-Karp hashes of every window of words.

1. Documents are bundled: rows of about ``BUNDLE_BYTES`` of text, compressed,
   numbered in slices of about ``SLICE_BYTES``. They are written out once, so
   that both passes below see the same slices.
2. A slice hashes every window of ``size`` words with a polynomial that rolls
   over them, keeps each hash once with its smallest document, sorts them, and
   deals them by hash into buckets. That shrinks a passage that a third of all
   documents share to one entry a slice before anything is shuffled. Hashes
   have 80 bits; the sorted ones are sent as differences.
3. A bucket, wherever Spark sends it, finds the smallest document of each hash
   over all slices and answers each slice with one bit an entry: whether a
   smaller document elsewhere has that window too.
4. The slice meets its bits, finds its windows again and adds the repeats
   within itself. Windows to remove that touch or overlap merge into maximal
   intervals, which are taken out.

The number of buckets grows with the text, so a bucket holds about as many
entries at every size; a hash all slices share adds one entry a slice to one.

Words are runs of characters other than ASCII white space, unchanged. A window
goes if its words also start a window in a document with a smaller ``doc_id``,
judged on the input. Rows that share an id do not remove each other's
windows. A null ``doc_id`` counts as larger than any id. Null and empty texts,
and texts with fewer words than a window, lose nothing; a null text has no
words and an empty rest. Rows are kept one for one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import park, text_slices
from .shared_keys import narrow, wide
from .text_arrays import SPACE, TextArrays, _Powers, mix

WINDOW = 13
BUNDLE_BYTES = 256 << 10
SLICE_BYTES = 4 << 20
# A slice numbers its documents in 16 bits.
SLICE_DOCS = 1 << 16
# Text for each bucket: about a million windows.
BUCKET_BYTES = 6 << 20
NO_ID = (1 << 63) - 1
# Ids in ascending order stay so as unsigned numbers with this bit turned.
_SIGN = np.uint64(1 << 63)
# Bundles are written and shuffled, so packing them tighter is worth its time.
TIGHT = 9

_KEY, _CHECK = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_ROLLS = [(_Powers(base), _Powers(pow(base, -1, 1 << 64))) for base in (_KEY, _CHECK)]
_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


def rolling_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` word hashes: each is the one before, less its first word, times the base, and a word more."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    up, down = _ROLLS[which]
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up.upto(len(words))[: len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down.upto(len(words))[: len(words) - size + 1])


class Slice:
    """The windows of some documents: the distinct ones in order, and which of them each window is."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], size: int):
        # documents in order of their ids, so that the first of equal windows has the smallest
        order = np.argsort(ids, kind="stable")
        self.ids, self.size = ids[order], size
        self.arrays = TextArrays([texts[i] for i in order.tolist()])
        words, n = self.arrays.word_hash, self.arrays.n_words
        text = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(text) - size + 1) + size <= np.repeat(self.arrays.word_bounds[1:], n)[: max(0, len(text) - size + 1)]
        self.first = np.flatnonzero(inside)
        self.text = text
        key = rolling_hashes(words, size)[self.first]
        check = (rolling_hashes(words, size, 1)[self.first] >> np.uint64(48)).astype(np.uint16)
        by_key = np.argsort(key, kind="stable")
        key, check = key[by_key], check[by_key]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        self.entry = np.empty(len(key), np.int64)
        self.entry[by_key] = np.cumsum(new) - 1
        self.keys, self.checks = key[new], check[new]
        self.least = text[self.first][by_key][new]

    def buckets(self, count: int) -> Iterator[tuple[int, slice]]:
        """Each bucket with entries, and the entries it gets."""
        bucket = ((self.keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield int(bucket[a]), slice(a, b)

    def covered(self, elsewhere: np.ndarray) -> np.ndarray:
        """Which words are in a window to remove; ``elsewhere`` marks entries that a smaller document of another slice has."""
        gone = elsewhere[self.entry] | (self.ids[self.text[self.first]] > self.ids[self.least[self.entry]])
        steps = np.zeros(len(self.text) + 1, np.int64)
        steps[self.first[gone]] += 1
        np.subtract.at(steps, self.first[gone] + self.size, 1)
        return np.cumsum(steps[:-1]) > 0


def bundles(docs: DataFrame) -> DataFrame:
    """The documents in compressed bundles: ``slice``, the bundle's number ``at`` in it, ``bytes`` of text and ``payload``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at, filled, n_docs = TaskContext.get().partitionId() << 32, 0, 0, 0
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], schema=_DOCS)
            with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=TIGHT))) as out:
                out.write_batch(batch)
            return pa.RecordBatch.from_pydict({"slice": [name], "at": [at], "bytes": [size], "payload": [sink.getvalue().to_pybytes()]})

        for batch, found in text_slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                ids.append(NO_ID if doc is None else doc)
                texts.append(text)
                size += len(text) + 1
                if size < BUNDLE_BYTES and len(ids) < SLICE_DOCS // 64:
                    continue
                yield row()
                at, filled, n_docs = at + 1, filled + size, n_docs + len(ids)
                ids, texts, size = [], [], 0
                if filled >= SLICE_BYTES or n_docs > SLICE_DOCS - SLICE_DOCS // 32:
                    name, at, filled, n_docs = name + 1, 0, 0, 0
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "slice long, at long, bytes long, payload binary")


def _opened(payloads: list[bytes], size: int) -> Slice:
    held = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in payloads])
    return Slice(held.column("doc_id").to_numpy(), held.column("text").to_pylist(), size)


def narrow_ids(ids: np.ndarray) -> bytes:
    """Ids in ascending order as the first one and differences, in as few bytes each as the largest needs."""
    return narrow(ids.astype(np.int64).view(np.uint64) ^ _SIGN)


def wide_ids(blob: bytes) -> np.ndarray:
    return (wide(blob) ^ _SIGN).view(np.int64)


def packed(numbers: np.ndarray, count: int) -> bytes:
    """Numbers below ``count`` in as many bits each as those need."""
    bits = max(1, (count - 1).bit_length())
    return np.packbits(((numbers[:, None] >> np.arange(bits)) & 1).astype(bool)).tobytes()


def unpacked(blob: bytes, count: int, n: int) -> np.ndarray:
    bits = max(1, (count - 1).bit_length())
    table = np.unpackbits(np.frombuffer(blob, np.uint8), count=n * bits).reshape(n, bits)
    return table @ (1 << np.arange(bits))


_DEALT = "bucket long, slice long, at long, n long, keys binary, checks binary, docs binary, least binary"


def dealt_windows(bundled: DataFrame, buckets: int, size: int) -> DataFrame:
    """For each bucket and stretch of a slice's bundles (``n`` from ``at`` on) the distinct windows and their smallest documents."""

    def rows(name: int, at: int, payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
        one = _opened(payloads, size)
        for bucket, part in one.buckets(buckets):
            used, least = np.unique(one.least[part], return_inverse=True)
            blobs = [narrow(one.keys[part]), one.checks[part].tobytes(), narrow_ids(one.ids[used]), packed(least, len(used))]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([x], pa.int64()) for x in (bucket, name, at, len(payloads))], *[pa.array([b], pa.binary()) for b in blobs]],
                names=[c.split()[0] for c in _DEALT.split(", ")],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, start = [], None, 0
        for batch in batches:
            for one, at, payload in zip(*(batch.column(c).to_pylist() for c in ("slice", "at", "payload")), strict=True):
                if held and (one != name or at != start + len(held)):
                    yield from rows(name, start, held)
                    held = []
                if not held:
                    name, start = one, at
                held.append(payload)
        if held:
            yield from rows(name, start, held)

    return bundled.select("slice", "at", "payload").mapInArrow(run, _DEALT)


def earlier_elsewhere(dealt: DataFrame) -> DataFrame:
    """For each bucket of a slice with such windows a bit an entry: whether another slice's smaller document has it."""
    sorted_rows = dealt.repartition("bucket").sortWithinPartitions("bucket", "slice", "at")

    def answers(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        keys = [wide(r["keys"]) for r in rows]
        checks = np.concatenate([np.frombuffer(r["checks"], np.uint16) for r in rows])
        ids = [wide_ids(r["docs"]) for r in rows]
        docs = np.concatenate([i[unpacked(r["least"], len(i), len(k))] for i, r, k in zip(ids, rows, keys, strict=True)])
        bounds = np.cumsum([0, *map(len, keys)])
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        ordered = joined[order]
        same = np.zeros(len(ordered) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        several = order[same[1:] | same[:-1]]
        # only those with a partner are sorted by the rest of the hash
        several = several[np.lexsort((checks[several], joined[several]))]
        bits = np.zeros(len(joined), bool)
        if len(several):
            k, c = joined[several], checks[several]
            first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]))
            least = np.minimum.reduceat(docs[several], first)
            bits[several] = docs[several] > np.repeat(least, np.diff([*first, len(several)]))
        for row, a, b in zip(rows, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if bits[a:b].any():
                values = [row["slice"], row["at"], row["n"], row["bucket"]]
                arrays = [*[pa.array([v], pa.int64()) for v in values], pa.array([np.packbits(bits[a:b]).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["slice", "at", "n", "bucket", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield from answers(held)
                    held = []
                held.append(row)
        if held:
            yield from answers(held)

    return sorted_rows.mapInArrow(run, "slice long, at long, n long, bucket long, payload binary")


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` (the intervals of words taken out: ``start`` and ``end``) and
    ``text``: the words that stay, joined by single spaces."""
    if size < 1:
        raise ValueError("a window has at least one word")
    bundled = park(bundles(docs), "bundles")
    total = bundled.agg(F.sum("bytes")).head()[0] or 0
    buckets = -(-total // BUCKET_BYTES) or 1
    bits = park(earlier_elsewhere(dealt_windows(bundled, buckets, size)), "window-bits")
    # the bits of a slice come before its bundles
    none = F.lit(None).cast("long")
    both = bits.unionByName(bundled.select("slice", "at", none.alias("n"), none.alias("bucket"), "payload"))
    in_order = both.repartition("slice").sortWithinPartitions("slice", F.col("n").isNull(), "at", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, answers, held = None, {}, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["slice"] != name:
                    yield from _finished(answers, held, buckets, size)
                    name, answers, held = row["slice"], {}, {}
                if row["n"] is None:
                    held[row["at"]] = row["payload"]
                else:
                    answers.setdefault((row["at"], row["n"]), {})[row["bucket"]] = row["payload"]
        yield from _finished(answers, held, buckets, size)

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, text string"
    return in_order.select("slice", "at", "n", "bucket", "payload").mapInArrow(run, schema)


def _finished(answers: dict, held: dict[int, bytes], buckets: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a slice: each stretch with answers by itself, as it asked, then whatever has none."""
    for (at, n), bits in answers.items():
        yield _rows(_opened([held.pop(i) for i in range(at, at + n)], size), bits, buckets)
    if held:
        yield _rows(_opened([held[i] for i in sorted(held)], size), {}, buckets)


def _rows(one: Slice, bits: dict[int, bytes], buckets: int) -> pa.RecordBatch:
    elsewhere = np.zeros(len(one.keys), bool)
    for bucket, part in one.buckets(buckets):
        if bucket in bits:
            elsewhere[part] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=part.stop - part.start).astype(bool)
    gone = one.covered(elsewhere)
    bounds, arrays = one.arrays.word_bounds, one.arrays
    edge = np.zeros(len(gone) + 1, bool)
    edge[bounds] = True
    # an interval starts or ends where the words change, or the text does
    start = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
    end = np.flatnonzero(gone & (edge[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
    begin = bounds[:-1][one.text[start]] if len(start) else start
    spans = pa.StructArray.from_arrays([pa.array(start - begin, pa.int64()), pa.array(end - begin, pa.int64())], names=["start", "end"])
    by_text = np.searchsorted(start, bounds).astype(np.int32)
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[bounds])
    ids = one.ids
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64(), mask=ids == NO_ID),
            pa.array(arrays.n_words, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.ListArray.from_arrays(pa.array(by_text), spans),
            _kept_texts(arrays, gone),
        ],
        names=["doc_id", "n_words", "n_removed", "spans", "text"],
    )


def _kept_texts(arrays: TextArrays, gone: np.ndarray) -> pa.Array:
    """The words that stay, one space between two of them, as strings."""
    kept = np.flatnonzero(~gone)
    bounds = np.searchsorted(kept, arrays.word_bounds)
    start, end = arrays.word_start[kept], arrays.word_end[kept]
    steps = np.zeros(len(arrays.data) + 2, np.int8)
    steps[start] += 1
    # with a word stays what follows it, as a space, but not behind the last word of a text
    after = end + 1
    after[bounds[1:][np.diff(bounds) > 0] - 1] -= 1
    steps[after] -= 1
    stays = np.cumsum(steps[:-2], dtype=np.int8) > 0
    data = np.where(SPACE[arrays.data], np.uint8(0x20), arrays.data)[stays]
    sizes = np.concatenate([[0], np.cumsum(after - start)])[bounds]
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(sizes.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
