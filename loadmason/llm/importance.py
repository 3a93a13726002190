"""Importance resampling towards a target: documents are drawn by how much their n-grams look like the target's.

Texts are lower-cased (A-Z only) and everything but letters, digits and
characters beyond ASCII becomes single spaces. A regular expression scanned
with overlaps gives the spans of all runs of 1 to ``max_words`` words; CRC-32
deals their bytes into ``buckets``. The bucket counts of the whole corpus and
of the whole target give each bucket a gain, and a document's weight is the
mean gain of its n-grams. Noise that depends on the id alone (Gumbel) makes
the highest scores a draw without replacement.

Counts are added up in tasks before they are shuffled: what comes to the
driver is one number a bucket. Ranks come from a range partitioning, not from
one task; equal scores go by the smaller id, then by a hash of the text.

Null texts, and texts without a word, have no n-grams, weight 0 and the score
of their noise. A null id is hashed as an empty one and comes after all ids.
Rows that share an id are documents of their own with the same noise. Other
columns are not read. Empty tables give no rows; an empty target gives each
bucket the gain of no target count.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import park, text_slices

MAX_WORDS = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

_OTHER = bytes(b for b in range(0x80) if not (chr(b).isdigit() or chr(b).isalpha()))
_TO_SPACE = bytes.maketrans(_OTHER, b" " * len(_OTHER))


def collapsed(text: bytes) -> bytes:
    """The words in lower case with one space between two."""
    return b" ".join(text.lower().translate(_TO_SPACE).split())


def patterns(max_words: int) -> list[regex.Pattern]:
    """One for each length: whole words with single spaces between them."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % more) for more in range(max_words)]


def gram_counts(text: bytes, scans: list[regex.Pattern]) -> Counter:
    line = collapsed(text)
    return Counter(m.group() for scan in scans for m in scan.finditer(line, overlapped=True))


def _hashed(text: bytes, scans: list[regex.Pattern], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and number of each different n-gram."""
    counts = gram_counts(text, scans)
    found = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts)) % buckets
    return found, np.fromiter(counts.values(), np.int64, len(counts))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans, total = patterns(max_words), np.zeros(buckets, np.int64)
        for _, found in text_slices(batches):
            for text in found:
                np.add.at(total, *_hashed(text, scans, buckets))
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of the smoothed frequencies, rounded down."""
    more_s, more_t = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array(
        [math.floor(1000 * math.log(((t + 1) * more_s) / ((s + 1) * more_t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)],
        np.int64,
    )


def weights(docs: DataFrame, gains: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, the number of words ``n`` and ``tie``, a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans = patterns(max_words)
        for batch, found in text_slices(batches):
            rows = []
            for text in found:
                buckets, counts = _hashed(text, scans, len(gains))
                n = int(counts.sum())
                words = n if max_words == 1 else collapsed(text).count(b" ") + (n > 0)
                rows.append((n, int((gains[buckets] * counts).sum()) // n if n else 0, words))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, batch.column("tie")], names=["doc_id", "n_features", "weight", "n", "tie"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    return columns.mapInArrow(run, "doc_id long, n_features long, weight long, n long, tie long")


def resample(
    docs: DataFrame, target: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``: the place in the draw, null where not drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = park(weights(docs, gains, max_words).withColumn("score", F.col("weight") + noise), "scores")
    able = F.col("n") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ranked = scored.where(able).select("doc_id", "n_features", "weight", "score", "tie")
    first = [F.desc("score"), F.asc_nulls_last("doc_id"), "tie", "n_features"]
    # counts up within a partition; the upper bits are the partition's number
    ordered = ranked.repartitionByRange(*first).sortWithinPartitions(*first).withColumn("place", F.monotonically_increasing_id())
    ordered = park(ordered.drop("tie"), "in-order").withColumn("part", F.shiftright("place", 33))
    # one row a partition
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("low"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("part").alias("its"), (before - F.col("low") + 1).alias("shift"))
    placed = ordered.join(F.broadcast(sizes), F.col("part") == F.col("its")).withColumn("rank", F.col("place") + F.col("shift"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.select(*columns, rank.alias("rank")).unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns, rows that share an id together."""
    chosen = resample(docs, target, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(chosen, F.col("doc_id").cast("long") == F.col("__drawn"), "left_semi")
