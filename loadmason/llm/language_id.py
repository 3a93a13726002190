"""Language identification by a convolutional network over bytes.

Filters of several widths slide over the bytes of fixed-length windows; the
largest response of each filter in a window is kept, and a softmax layer makes
probabilities of them. A text is cut into windows, all of them are classified,
and their probabilities are averaged by the letters they hold.

The network is trained in numpy on windows of at most ``TRAIN_DOCS`` labelled
documents for each language, taken from all over their texts. ASCII letters
are lower-cased and other ASCII characters count as spaces, so numbers, marks
and capitals carry no weight.

A null text, or one without a letter, is ``und`` with score 0. Without any
labelled document everything is ``und``. Null languages teach nothing. Rows
that share an id stay apart; of the other columns none is read for a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
MIN_SCORE = 0.5

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
# The sample the network is fitted to: documents of a language, windows of a document, languages.
TRAIN_DOCS, TRAIN_WINDOWS, MAX_LANGUAGES = 600, 4, 500
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 11
# Windows that go through the network at once.
FORWARD = 64

_LETTER = re.compile(rb"[A-Za-z]")
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    plain = text.translate(_PLAIN)
    return np.frombuffer(plain + bytes(-len(plain) % WINDOW), np.uint8).reshape(-1, WINDOW)


def has_letter(text: bytes) -> bool:
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


@dataclass
class Network:
    """A table of filter responses for each width and place, and the layer above the pooled responses."""

    languages: list[str]
    tables: list[np.ndarray]  # for each width: places x 256 x filters
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def __post_init__(self) -> None:
        self._pairs: list | None = None

    def pairs(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """Tables over two neighbouring bytes at once, which halves the look-ups: (place, bytes, table)."""
        if self._pairs is None:
            self._pairs = []
            for table in self.tables:
                steps = []
                for k in range(0, len(table) - 1, 2):
                    both = table[k][:, None, :] + table[k + 1][None, :, :]
                    steps.append((k, 2, both.reshape(1 << 16, -1)))
                if len(table) % 2:
                    steps.append((len(table) - 1, 1, table[-1]))
                self._pairs.append(steps)
        return self._pairs

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each window."""
        one = x.astype(np.intp)
        two = one[:, :-1] * 256 + one[:, 1:]
        out = []
        for width, steps in zip(WIDTHS, self.pairs(), strict=True):
            n = x.shape[1] - width + 1
            total = None
            for place, size, table in steps:
                found = table.take((two if size == 2 else one)[:, place : place + n], axis=0)
                total = found if total is None else np.add(total, found, out=total)
            out.append(total.max(axis=1))
        return np.concatenate(out, axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [np.zeros((0, len(self.languages)))]
        for a in range(0, len(x), FORWARD):
            hidden = np.maximum(self.pooled(x[a : a + FORWARD]) + self.bias, 0)
            parts.append(_softmax(hidden @ self.weights + self.offsets))
        return np.concatenate(parts)

    def classify(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The language of each whole text and the mean probability of it."""
        x = [windows(t) for t in texts]
        bounds = np.cumsum([0, *map(len, x)])
        joined = np.concatenate([np.zeros((0, WINDOW), np.uint8), *x])
        weight = ((joined != 0x20) & (joined != 0)).sum(1)
        sums = np.zeros((len(joined) + 1, len(self.languages)))
        np.cumsum(self.probabilities(joined) * weight[:, None], axis=0, out=sums[1:])
        mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(1, np.add.reduceat(np.append(weight, 0), bounds[:-1]))[:, None]
        best = mean.argmax(1)
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            known = has_letter(text)
            names.append(self.languages[best[i]] if known else UNDETERMINED)
            scores[i] = min(1.0, max(0.0, mean[i, best[i]])) if known else 0.0
        return names, scores


def _softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Network:
    """Fits the network to labelled windows by Adam on the cross-entropy."""
    random = np.random.default_rng(SEED)
    draw = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    hidden = FILTERS * len(WIDTHS)
    params = [*(draw(w, 256, FILTERS) for w in WIDTHS), np.zeros(hidden, np.float32), draw(hidden, len(languages))]
    params.append(np.zeros(len(languages), np.float32))
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for a in range(0, len(x), BATCH):
            rows = order[a : a + BATCH]
            step += 1
            for p, g, m, v in zip(params, _gradients(params, x[rows], y[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return Network(languages, params[: len(WIDTHS)], *params[len(WIDTHS) :])


def _gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    tables, (bias, weights, offsets) = params[: len(WIDTHS)], params[len(WIDTHS) :]
    index = x.astype(np.intp)
    pooled, places = [], []
    for table, width in zip(tables, WIDTHS, strict=True):
        n = x.shape[1] - width + 1
        total = sum(table[k].take(index[:, k : k + n], axis=0) for k in range(width))
        at = total.argmax(axis=1)
        places.append(at)
        pooled.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
    before = np.concatenate(pooled, axis=1) + bias
    hidden = np.maximum(before, 0)
    error = _softmax(hidden @ weights + offsets)
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    back = (error @ weights.T) * (before > 0)
    out = []
    for i, (table, width) in enumerate(zip(tables, WIDTHS, strict=True)):
        gradient = np.zeros_like(table)
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        filters = np.broadcast_to(np.arange(FILTERS), own.shape)
        for k in range(width):
            # only the place of the largest response passes anything on
            np.add.at(gradient[k], (np.take_along_axis(index, places[i] + k, 1), filters), own)
        out.append(gradient)
    return [*out, back.sum(0), hidden.T @ error, error.sum(0)]


def fold(doc_id: Column, folds: int) -> Column:
    """A document's fold; a null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def learn(docs: DataFrame) -> Network | None:
    """A network from the documents that have a language and are not held out."""
    labelled = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    # of every language about as many documents, chosen by a hash of their id
    every = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, max(1, r["count"] // TRAIN_DOCS))])
    chosen = labelled.withColumn("every", every[F.col("lang")]).where("pmod(xxhash64(doc_id), every) = 0")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                x = windows(text)
                for i in np.unique(np.linspace(0, len(x) - 1, TRAIN_WINDOWS).astype(int)).tolist() if len(x) else []:
                    langs.append(lang)
                    found.append(x[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "window"])

    cuts = chosen.select("lang", "text").mapInArrow(cut, "lang string, window binary")
    rows = cuts.limit(2 * TRAIN_DOCS * TRAIN_WINDOWS * len(counts)).orderBy("lang", "window").collect()
    languages = sorted({r.lang for r in rows})
    if not rows:
        return None
    x = np.frombuffer(b"".join(bytes(r.window) for r in rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([languages.index(r.lang) for r in rows]), languages)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of each document, learned from those outside a fold."""
    network = learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            names, scores = _classify(network, texts)
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    held_out = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, with all their columns, whose language is found with some certainty."""
    network = learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices([batch]):
                names, scores = _classify(network, texts)
                known = np.array([n != UNDETERMINED for n in names], bool)
                yield rows.filter(pa.array(known & (scores >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def _classify(network: Network | None, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
    return ([UNDETERMINED] * len(texts), np.zeros(len(texts))) if network is None else network.classify(texts)
