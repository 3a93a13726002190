"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every token of the rank file becomes a piece: its bytes, each as one printable
character, scored by its negative rank, so that merging the best-scored
neighbours is merging the lowest rank. Nothing is normalised. A text is split
by the vocabulary's pattern; a match that is a token itself is that token, any
other is encoded by the model. Decoding maps the pieces' characters back.

A null text is empty: no ids, and the digests of nothing. Other columns are
not read; rows that share an id stay apart.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices
from .units import PieceStore, encode_whole

RANKS = "byte_bpe_multi_50k.tiktoken"
_CODECS: dict[tuple[str, str], ByteBpe] = {}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("the ranks are not 0, 1, 2 and so on")
    return tokens


def byte_characters() -> list[str]:
    """A printable character for each byte: its own where it has one, else one past the Latin letters."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(0x100 + others.index(b)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """A field of a protocol buffer message."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


# Fixed values of the sentencepiece model format: field numbers, and the types of models and pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, BPE = 3, 2
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 40, 41, 42, 43
UNKNOWN = 2
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose ids are the tokens' ranks; one unknown piece follows them."""
    characters = byte_characters()
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(characters[b] for b in token).encode()
        out.append(_field(PIECES, _field(PIECE, piece) + _field(SCORE, -float(rank))))
    out.append(_field(PIECES, _field(PIECE, b"<unk>") + _field(SCORE, 0.0) + _field(KIND, UNKNOWN)))
    special = _field(UNK_ID, len(tokens)) + _field(BOS_ID, -1) + _field(EOS_ID, -1) + _field(PAD_ID, -1)
    out.append(_field(TRAINER, _field(MODEL_TYPE, BPE) + special))
    plain = _field(DUMMY_PREFIX, 0) + _field(EXTRA_SPACES, 0) + _field(ESCAPE_SPACES, 0)
    out.append(_field(NORMALIZER, _field(NAME, b"identity") + plain))
    return b"".join(out)


class ByteBpe:
    """Encodes and decodes with one rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.ranks = {t: r for r, t in enumerate(self.tokens)}
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.characters = byte_characters()
        self.decimals = [str(r) for r in range(len(self.tokens))]
        self.store = PieceStore(self._encode_pieces)
        back = {c: bytes([b]) for b, c in enumerate(self.characters)}
        pieces = [self.model.id_to_piece(r) for r in range(len(self.tokens))]
        self.decoded = [b"".join(back[c] for c in piece) for piece in pieces]

    def _encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        matches = [[m.encode() for m in self.pattern.findall(p.decode())] for p in pieces]
        unknown = list({m for found in matches for m in found if m not in self.ranks})
        mapped = ["".join([self.characters[b] for b in m]) for m in unknown]
        encoded = dict(zip(unknown, self.model.encode(mapped, num_threads=1), strict=True)) if unknown else {}
        return [[i for m in found for i in ([self.ranks[m]] if m in self.ranks else encoded[m])] for found in matches]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return encode_whole(texts, self.store)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.decoded[i] for i in ids])

    def written(self, ids: list[int]) -> bytes:
        """The ids in decimal, joined by commas."""
        return ",".join([self.decimals[i] for i in ids]).encode()


def codec(path: str, pattern: str) -> ByteBpe:
    """One codec for each task, or for a worker that has the package installed."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and the ``ids`` of each document's whole text."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch, texts in text_slices(batches):
            ids = pa.array([i.astype(np.int32) for i in bpe.encode(texts)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return _keyed(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id`` and the decoded bytes of each row of ``ids``; null ids decode to nothing."""
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            decoded = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per document the number of ids, the SHA-256 of the decimal ids joined by commas, and that of the decoded ids.

    Both directions run in one pass, so ids never travel between processes.
    """
    path = path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch, texts in text_slices(batches):
            sizes, ids_digests, decoded_digests = [], [], []
            for ids in map(np.ndarray.tolist, bpe.encode(texts)):
                sizes.append(len(ids))
                ids_digests.append(hashlib.sha256(bpe.written(ids)).hexdigest())
                decoded_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_digests), pa.array(decoded_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
