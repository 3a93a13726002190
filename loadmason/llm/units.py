"""Encoding texts by pieces that never influence each other, each distinct piece encoded once.

Byte-level pre-tokenisation never joins a character with a space that follows
it, and what starts at that space does not look back. So a text may be cut in
front of every space that follows a character other than white space, on both
sides of a single line end between two such characters, and between an ASCII
letter and a mark (not an apostrophe, and none that special tokens hold). The same pieces come up again and
again; they are told apart by 64-bit hashes, and a store of bounded size holds
the ids each encodes to.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from .text_arrays import byte_table, span_hashes

# About 40 bytes each.
STORED_PIECES = 1_000_000

# ASCII white space in the widest sense.
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
# First bytes of the white space beyond ASCII.
_SPACE_LEAD = np.zeros(256, bool)
_SPACE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = byte_table(bytes(b for b in range(0x80) if chr(b).isalpha()))
_MARK = byte_table(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in "'<|>"))


class PieceStore:
    """The ids of pieces. ``encode`` takes a list of pieces and gives a list of ids for each."""

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = STORED_PIECES):
        self.encode = encode
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.empty(0, np.uint64)  # sorted hashes of the pieces
        self.rows = np.empty(0, np.int64)  # where in ends each one's ids are
        self.flat = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after another, and the number of each piece's ids."""
        if not len(start):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        hashes, first, where = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        new = self._unknown(hashes)
        if len(new) and len(self.keys) + len(new) > self.limit:
            # what is wanted now stays, the rest is learned again when it comes up
            known = np.delete(hashes, new)
            ids, counts = self._gather(self._rows(known))
            self._clear()
            self._add(known, ids, counts)
        if len(new):
            spans = zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)
            found = self.encode([data[a:b].tobytes() for a, b in spans])
            counts = np.fromiter(map(len, found), np.int64, len(found))
            self._add(hashes[new], np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts)
        return self._gather(self._rows(hashes)[where])

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(hashes))
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.flatnonzero(self.keys[place] != hashes)

    def _rows(self, hashes: np.ndarray) -> np.ndarray:
        return self.rows[np.searchsorted(self.keys, hashes)]

    def _gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.ends[rows]
        counts = self.ends[rows + 1] - begin
        before = np.cumsum(counts) - counts
        return self.flat[np.repeat(begin - before, counts) + np.arange(int(counts.sum()))], counts

    def _add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        used = int(self.ends[-1])
        if used + len(ids) > len(self.flat):
            grown = np.empty(2 * (used + len(ids)), np.uint32)
            grown[:used] = self.flat[:used]
            self.flat = grown
        self.flat[used : used + len(ids)] = ids
        rows = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(hashes))
        self.ends = np.concatenate([self.ends, used + np.cumsum(counts)])
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.rows = np.insert(self.keys, place, hashes), np.insert(self.rows, place, rows)


def byte_pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined texts, start and end of their pieces, and the pieces' bounds by text."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    inside = np.ones(len(data) + 1, bool)
    inside[bounds] = False  # a cut there is the end of a text
    spaces = np.flatnonzero(data == 0x20)
    cuts = [spaces[inside[spaces] & ~_after_space(data, spaces)]]
    ends = np.flatnonzero(data == 0x0A)
    ends = ends[inside[ends] & inside[ends + 1]]
    ends = ends[~_after_space(data, ends) & ~_ASCII_SPACE[data[ends + 1]] & ~_SPACE_LEAD[data[ends + 1]]]
    # the line end added after a text is no piece
    ends = ends[~np.isin(ends, bounds[1:] - 1)]
    marks = np.flatnonzero(_MARK[data])
    marks = marks[inside[marks] & _LETTER[data[np.maximum(marks - 1, 0)]]]
    cuts += [ends, ends + 1, marks]
    filled = np.diff(bounds) > 1
    at = np.zeros(len(data) + 1, bool)
    at[np.concatenate([*cuts, bounds[:-1][filled]])] = True
    start = np.flatnonzero(at)
    last = np.searchsorted(start, bounds[1:]) - 1
    end = np.append(start[1:], 0)
    end[last[filled]] = (bounds[1:] - 1)[filled]
    return data, start, end, np.searchsorted(start, bounds)


def _after_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is white space, in or beyond ASCII."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    narrow = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    general = (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    other = ((three == 0xE2) & (two == 0x81) & (one == 0x9F)) | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
    return _ASCII_SPACE[one] | narrow | general | other | ((three == 0xE3) & (two == 0x80) & (one == 0x80))


def encode_whole(texts: list[bytes], store: PieceStore) -> list[np.ndarray]:
    """The ids of each text."""
    data, start, end, bounds = byte_pieces(texts)
    ids, counts = store.ids(data, start, end)
    ends = np.concatenate([[0], np.cumsum(counts)])[bounds]
    return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def worker_stores() -> dict:
    """What a Python worker keeps from one task to the next.

    This code is sent along with each task, so its own names are new every
    time; a module of that name in the worker is not. What is stored never
    changes a result, it only saves finding it again.
    """
    return vars(sys.modules.setdefault("_loadmason_worker", types.ModuleType("_loadmason_worker"))).setdefault("stores", {})


def tokenizer_store(path: str) -> PieceStore:
    """The store of a tokenizer's pieces; there is one for each worker."""
    stores = worker_stores()
    if path not in stores:
        # Spark already runs a task on every core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        stores[path] = PieceStore(lambda pieces: encode_pieces(tokenizer, pieces))
    return stores[path]


def encode_pieces(tokenizer: Tokenizer, pieces: list[bytes]) -> list:
    """The ids of each piece. Most are encoded in one text, as a call costs more than a piece.

    A text of pieces that each are a space and then characters other than
    white space has their ids, one piece after another; places tell them
    apart. Where the vocabulary drops spaces, one may be put before a piece.
    """
    words = [p.decode() for p in pieces]
    drops = not tokenizer.encode(" ", add_special_tokens=False).ids
    out: list = [None] * len(words)
    joined, texts = [], []
    for i, word in enumerate(words):
        spaced = " " + word if drops and word[0] != " " else word
        if spaced[0] == " " and spaced[1:].split() == [spaced[1:]] and "<|" not in spaced:
            joined.append(i)
            texts.append(spaced)
    if joined:
        found = tokenizer.encode("".join(texts), add_special_tokens=False)
        ids = found.ids
        places = np.array(found.offsets, np.int64).reshape(-1, 2)[:, 0]
        cuts = np.searchsorted(places, np.cumsum([0, *map(len, texts)]))
        for i, a, b in zip(joined, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[i] = ids[a:b]
    others = [i for i, ids in enumerate(out) if ids is None]
    for i, found in zip(others, tokenizer.encode_batch([words[i] for i in others], add_special_tokens=False), strict=True):
        out[i] = found.ids
    return out
