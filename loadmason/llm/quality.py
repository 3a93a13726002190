"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each class (label 0 and 1) is a Gaussian over transformed statistics of a text.
Its mean and covariance come from sums over all labelled documents, taken by
Spark; the covariance is drawn towards the pooled one and towards its own
diagonal mean (shrinkage), and its Cholesky factor is kept in the model, so a
document costs two triangular solves. The score is the posterior of label 1.

A null or empty text has statistics like any other and gets a score. A null
label is no label; a class without a labelled document takes the pooled
Gaussian. Without any labels every score is 0.5. Rows that share an id stay
apart, and a document labelled several times counts each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import park, release, text_slices
from .text_arrays import SPACE, TextArrays, byte_table, distinct_words, doubled_words, duplicate_lines, repeated_words

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# Weights of the pooled covariance and of the diagonal mean in a class's covariance.
POOLED, DIAGONAL = 0.2, 0.02

STATISTICS = (
    "log_words", "log_word_length", "log_symbols", "log_marks", "upper", "digits", "stops",
    "distinct", "log_doubled", "repeats", "log_line_words", "entropy",
)

_SYMBOLS = byte_table(b"#*$%&|<>{}[]\\^~_=+@")
_MARKS = byte_table(b"!?")
_STOPS = byte_table(b".,;:")
_UPPER = byte_table(bytes(range(0x41, 0x5B)))
_DIGITS = byte_table(bytes(range(0x30, 0x3A)))


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` for each text. Small counts are drawn to what a plain text shows."""
    arrays = TextArrays(texts)
    n = arrays.n_words.astype(float)
    count = lambda table: arrays.count_bytes(table).astype(float)
    characters = count(~SPACE)
    lines, _ = duplicate_lines(arrays)
    text = np.repeat(np.arange(len(texts)), np.diff(arrays.doc_bounds))
    cells = np.bincount(text * 256 + arrays.data, minlength=256 * len(texts)).reshape(-1, 256)
    shares = cells / np.maximum(cells.sum(1, keepdims=True), 1)
    entropy = -(shares * np.log2(np.where(shares > 0, shares, 1))).sum(1)
    distinct = distinct_words(arrays)
    return np.stack(
        [
            np.log1p(n),
            np.log((characters + 50) / (n + 10)),
            np.log((count(_SYMBOLS) + 0.2) / (n + 6)),
            np.log((count(_MARKS) + 0.2) / (n + 6)),
            np.sqrt((count(_UPPER) + 1) / (characters + 50)),
            np.sqrt((count(_DIGITS) + 0.5) / (characters + 50)),
            np.sqrt((count(_STOPS) + 1) / (characters + 50)),
            np.log(distinct + 10) - 0.9 * np.log(n + 10),
            np.log((doubled_words(arrays) + 0.2) / (n + 6)),
            np.sqrt((repeated_words(arrays, 5) + 5) / (n + 60)),
            np.log((n + 10) / (lines + 1.0)),
            entropy * n / (n + 20),
        ],
        axis=1,
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = pa.array(list(statistics(texts)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, stats array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors and log weights of the two classes."""

    means: np.ndarray
    factors: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, n: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant | None:
        """From each class's number of rows, sum of rows and sum of outer products."""
        if not n.sum():
            return None
        size = sums.shape[1]
        mean = sums.sum(0) / n.sum()
        means = np.stack([s / k if k else mean for s, k in zip(sums, n, strict=True)])
        scatter = np.stack([q - k * np.outer(m, m) for q, k, m in zip(squares, n, means, strict=True)])
        pooled = scatter.sum(0) / n.sum()
        scale = np.maximum(np.diag(pooled), 1e-6)
        factors = []
        for one, k in zip(scatter, n, strict=True):
            own = one / k if k > size else pooled
            drawn = (1 - POOLED) * own + POOLED * pooled
            drawn = (1 - DIAGONAL) * drawn + DIAGONAL * np.diag(scale)
            factors.append(np.linalg.cholesky(drawn + 1e-9 * np.eye(size)))
        factors = np.stack(factors)
        logs = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1)
        return cls(means, factors, np.log((n + 1) / (n + 1).sum()) - logs)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The posterior of class 1, from the difference of the two log densities."""
        logs = [
            w - 0.5 * (np.linalg.solve(f, (rows - m).T) ** 2).sum(0)
            for m, f, w in zip(self.means, self.factors, self.weights, strict=True)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(labelled: DataFrame) -> Discriminant | None:
    """Fits the classes to rows of ``label`` and ``stats``, all of them; only sums are shuffled."""
    size = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {0: np.zeros(1 + size + size * size), 1: np.zeros(1 + size + size * size)}
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            rows = np.array(batch.column("stats").to_pylist())
            for label, total in totals.items():
                own = rows[labels == label]
                total += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        place = np.tile(np.arange(1 + size + size * size), 2)
        label = np.repeat([0, 1], 1 + size + size * size)
        arrays = [pa.array(label, pa.int32()), pa.array(place, pa.int32()), pa.array(np.concatenate([totals[0], totals[1]]))]
        yield pa.RecordBatch.from_arrays(arrays, names=["label", "place", "value"])

    parts = labelled.select(F.col("label").cast("int").alias("label"), "stats").mapInArrow(sums, "label int, place int, value double")
    # a row for each sum, whatever the number of documents
    total = np.zeros((2, 1 + size + size * size))
    for row in parts.groupBy("label", "place").agg(F.sum("value").alias("value")).collect():
        total[row.label, row.place] = row.value
    return Discriminant.fit(total[:, 0], total[:, 1 : 1 + size], total[:, 1 + size :].reshape(2, size, size))


def fold(doc_id: Column, folds: int) -> Column:
    """A document's fold; a null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def learn(measured: DataFrame, labels: DataFrame) -> Discriminant | None:
    """The model from the measured documents that have a label and are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    return fit(measured.join(known, "doc_id"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document.

    The model sees ``labels.quality`` of documents outside the held-out fold only.
    """
    measured = park(document_statistics(docs), "statistics")
    model = learn(measured, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(model, np.array(batch.column("stats").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = measured.mapInArrow(run, "doc_id long, score double")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns.

    Texts are measured again where they lie, so no text is shuffled. What is learned from is
    written first: measuring and adding up in one stage would take two Python workers a core.
    """
    measured = park(document_statistics(docs), "statistics")
    model = learn(measured, labels)
    release(measured)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices([batch]):
                yield rows.filter(pa.array(_scores(model, statistics(texts)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def _scores(model: Discriminant | None, rows: np.ndarray) -> np.ndarray:
    return np.full(len(rows), 0.5) if model is None or not len(rows) else model.score(rows)
