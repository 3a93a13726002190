"""Words, lines and shingles of many texts at once, as numpy arrays over their joined bytes.

A word is a run of bytes other than ASCII white space (\\x20, \\x09-\\x0D); a
line ends at \\n. Words and lines are told apart by 64-bit hashes: sums of a
random number for each byte times a power of an odd base, taken as differences
of running sums, so no word is handled by itself.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240607))


def _numbers(count: int) -> np.ndarray:
    return _RANDOM.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _numbers(256)
_PLACE = _numbers(64)
_SHORT = _numbers(64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
# Running sums start anew after this many bytes.
_BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits, one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = np.uint64(pow(self.base, len(self.known), 1 << 64))
            self.known = np.concatenate([self.known, self.known * step])
        return self.known


_UP, _DOWN = _Powers(_BASE), _Powers(_BASE_INVERSE)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans; they are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = max(i + 1, int(np.searchsorted(start, low + _BLOCK)))
        high = int(end[j - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE[data[low:high]] * _UP.upto(high - low)[: high - low], out=sums[1:])
        a, b = start[i:j] - low, end[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * _DOWN.upto(high - low)[np.minimum(a, high - low - 1)] if high > low else 0
        i = j
    return mix(out + (end - start).astype(np.uint64))


def sort_segments(values: np.ndarray, bounds: np.ndarray) -> None:
    """Sorts each segment in place."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()


def distinct_in_segments(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each segment, and the segments' new bounds."""
    sort_segments(values, bounds)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    return values[new], np.concatenate([[0], np.cumsum(new)])[bounds]


class TextArrays:
    """The words of the texts: ``word_start``, ``word_end`` in ``data``, and ``word_bounds`` by text."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join([*texts, b""])
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = np.concatenate([[False], ~SPACE[self.data]])
        changes = np.flatnonzero(inside[1:] != inside[:-1])
        self.word_start, self.word_end = changes[::2], changes[1::2]
        self.word_bounds = np.searchsorted(self.word_start, self.doc_bounds)
        self.n_words = np.diff(self.word_bounds)
        self._hashes: np.ndarray | None = None

    @property
    def word_hash(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.word_start, self.word_end)
        return self._hashes

    def count_bytes(self, table: np.ndarray) -> np.ndarray:
        """For each text the number of its bytes that the table of 256 marks."""
        sums = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        # the last byte of each text here is the added line end
        return sums[self.doc_bounds[1:] - 1] - sums[self.doc_bounds[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each line, and the lines' bounds by text; an empty text is one line."""
        end = np.flatnonzero(self.data == 10)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        return start, end, np.searchsorted(start, self.doc_bounds)

    def window_hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``size`` words inside a text."""
        total = len(self.word_start) - size + 1
        if total <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        hashes = np.zeros(total, np.uint64)
        for j in range(size):
            hashes += self.word_hash[j : j + total] * _PLACE[j]
        keep = np.ones(total, bool)
        for j in range(1, size):
            # no run over the end of a text
            cut = self.word_bounds[1:-1] - j
            keep[cut[(cut >= 0) & (cut < total)]] = False
        first = np.flatnonzero(keep)
        return first, mix(hashes[first])

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, sorted, and their bounds by text.

        A text of fewer words is one shingle as a whole; without words it has none.
        """
        first, hashes = self.window_hashes(size)
        n = self.n_words
        counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        out = np.empty(int(counts.sum()), np.uint64)
        from_windows = np.repeat(n >= size, counts)
        out[from_windows] = hashes
        short = np.flatnonzero((n > 0) & (n < size))
        whole = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            here = n[short] > j
            whole[here] += self.word_hash[self.word_bounds[short[here]] + j] * _PLACE[j]
        out[~from_windows] = mix(whole + _SHORT[n[short]])
        return distinct_in_segments(out, np.concatenate([[0], np.cumsum(counts)]))


def byte_table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


def repeated_words(arrays: TextArrays, size: int) -> np.ndarray:
    """Words of each text in runs of ``size`` words that come up at least twice in it."""
    first, hashes = arrays.window_hashes(size)
    text = np.repeat(np.arange(len(arrays.n_words)), arrays.n_words)
    keys = mix(hashes + (text[first].astype(np.uint64) + np.uint64(1)) * _PLACE[63])
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(arrays.n_words), np.int64)
    hits = first[np.isin(keys, twice)]
    steps = np.zeros(len(text) + 1, np.int64)
    steps[hits] += 1
    steps[hits + size] -= 1
    return np.bincount(text[np.cumsum(steps[:-1]) > 0], minlength=len(arrays.n_words))


def duplicate_lines(arrays: TextArrays) -> tuple[np.ndarray, np.ndarray]:
    """For each text its lines with a word, and how many of them equal an earlier line."""
    start, end, bounds = arrays.lines()
    worded = np.searchsorted(arrays.word_start, end) > np.searchsorted(arrays.word_start, start)
    counts = np.add.reduceat(worded, bounds[:-1], dtype=np.int64) if len(worded) else np.zeros(0, np.int64)
    hashes = span_hashes(arrays.data, start, end)[worded]
    _, new = distinct_in_segments(hashes, np.concatenate([[0], np.cumsum(counts)]))
    return counts, counts - np.diff(new)


def distinct_words(arrays: TextArrays) -> np.ndarray:
    return np.diff(distinct_in_segments(arrays.word_hash.copy(), arrays.word_bounds)[1])


def doubled_words(arrays: TextArrays) -> np.ndarray:
    """Words of each text that equal the word before them."""
    text = np.repeat(np.arange(len(arrays.n_words)), arrays.n_words)
    same = (arrays.word_hash[1:] == arrays.word_hash[:-1]) & (text[1:] == text[:-1])
    return np.bincount(text[1:][same], minlength=len(arrays.n_words))
