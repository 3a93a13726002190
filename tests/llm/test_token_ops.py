"""Byte-level BPE, token files and packing against the libraries themselves."""

import base64
import hashlib
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loadmason.llm import byte_bpe, packing, token_files
from loadmason.llm.units import PieceStore, byte_pieces, encode_pieces, encode_whole, tokenizer_store
from loadmason.session import new_path

from .conftest import clashing


@cache
def multi():
    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = "ab '.,-!\n\t é😀\x1c.s1\x85\xa0 　Σİ́"


@given(st.text(alphabet=ODD))
@settings(max_examples=300, deadline=None)
def test_pieces_join_to_the_text(text):
    texts = [text.encode(), b"", text.encode() + b" end"]
    data, start, end, bounds = byte_pieces(texts)
    for i, one in enumerate(texts):
        pieces = zip(start[bounds[i] : bounds[i + 1]].tolist(), end[bounds[i] : bounds[i + 1]].tolist(), strict=True)
        assert b"".join(data[a:b].tobytes() for a, b in pieces) == one


@given(st.text(alphabet=ODD) | st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoding_by_pieces_is_that_of_the_whole(text):
    codec = byte_bpe.codec(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    ids = codec.encode([text.encode()])[0].tolist()
    assert ids == multi().encode_ordinary(text)
    assert codec.decode(ids) == text.encode()
    want = tokenizer(token_files.TOKENIZER).encode(text, add_special_tokens=False).ids
    assert token_files.encode_texts([text.encode()], public_tokenizers.path(token_files.TOKENIZER))[0].tolist() == [*want, 2]
    want = tokenizer(packing.TOKENIZER).encode(text, add_special_tokens=False).ids
    found = encode_whole([text.encode()], tokenizer_store(public_tokenizers.path(packing.TOKENIZER)))
    assert found[0].tolist() == want


@pytest.mark.parametrize("name", [token_files.TOKENIZER, packing.TOKENIZER])
def test_pieces_encoded_together_are_those_encoded_alone(name, odd_texts):
    pieces = sorted({w for t in odd_texts for w in (t or "").encode().split()})
    pieces = [" don't".encode(), b"x", *(p for w in pieces for p in (w, b" " + w))]
    for piece, ids in zip(pieces, encode_pieces(tokenizer(name), pieces), strict=True):
        assert list(ids) == tokenizer(name).encode(piece.decode(), add_special_tokens=False).ids


def test_a_full_store_forgets_only_what_is_not_wanted():
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return [list(p) for p in pieces]

    store = PieceStore(encode, limit=3)
    for text, new in ((b"a bb", [b"a", b" bb"]), (b"a a ccc", [b" a", b" ccc"]), (b"a bb", [b" bb"])):
        asked.clear()
        assert encode_whole([text], store)[0].tolist() == list(text)
        assert sorted(asked) == sorted(new)



def test_bpe_is_that_of_the_library(odd_docs, odd_texts):
    rows = byte_bpe.round_trip_digests(clashing(odd_docs)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(odd_texts)))
    for r in rows:
        text = odd_texts[r.doc_id] or ""
        ids = multi().encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encode_then_decode(odd_docs, odd_texts, no_docs):
    encoded = byte_bpe.encode_documents(odd_docs)
    for r in byte_bpe.decode_documents(encoded).collect():
        assert bytes(r.decoded) == (odd_texts[r.doc_id] or "").encode()
    assert byte_bpe.round_trip_digests(no_docs).count() == 0


def test_token_files(spark, odd_docs, odd_texts, no_docs):
    folder = new_path(spark, "tokens")
    token_files.write_token_files(clashing(odd_docs), folder, shard_bytes=2000)
    want, before = [], 0
    for i, text in enumerate(odd_texts):
        ids = [*tokenizer(token_files.TOKENIZER).encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, before, len(ids), ids))
        before += len(ids)
    read = token_files.read_token_files(spark, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids) for r in read) == want
    digests = token_files.read_token_files(spark, folder, digest=True).collect()
    assert sorted(tuple(r) for r in digests) == [(*row[:3], crc(row[3])) for row in want]
    some = token_files.read_token_files(spark, folder, doc_ids=[3, 20]).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids) for r in some) == [want[3], want[20]]

    empty = new_path(spark, "tokens")
    token_files.write_token_files(no_docs, empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_token_files_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(5, "b"), (None, "a a"), (5, "b"), (1, None)], "doc_id long, text string")
    folder = new_path(spark, "tokens")
    token_files.write_token_files(docs, folder)
    rows = sorted(((r.start, r.doc_id, r.n_tokens) for r in token_files.read_token_files(spark, folder).collect()))
    assert rows == [(0, None, 3), (3, 1, 1), (4, 5, 2), (6, 5, 2)]


def test_first_fit_takes_the_first_bin_with_room():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 300):
        lengths = np.sort(rng.integers(1, 50, n))[::-1]
        room, want = [], []
        for size in lengths.tolist():
            at = next((i for i, r in enumerate(room) if r >= size), len(room))
            if at == len(room):
                room.append(50)
            want.append((at, 50 - room[at]))
            room[at] -= size
        bins, offsets = packing.first_fit(lengths, 50)
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == want


def test_packing_holds_every_id_once(odd_docs, odd_texts, no_docs):
    rows = packing.pack(packing.cut_pieces(clashing(odd_docs), length=64), length=64, group_pieces=100).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(pieces) == list(range(len(odd_texts)))
    for doc, found in pieces.items():
        ids = [*tokenizer(packing.TOKENIZER).encode(odd_texts[doc] or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * total / 64 + len(rows) / 100 + 2
    assert packing.pack_documents(no_docs).count() == 0


def test_packing_keeps_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "one two")] * 3 + [(None, None)], "doc_id long, text string")
    rows = packing.pack_documents(docs).collect()
    assert len(rows) == 4
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_packing_gives_out_the_ids(odd_docs, odd_texts):
    packed = packing.pack(packing.cut_pieces(odd_docs, length=64), length=64, group_pieces=100).cache()
    rows = packed.collect()
    held = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    want = {i: [*tokenizer(packing.TOKENIZER).encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(odd_texts)}
    got = {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        whole = np.frombuffer(held[r.sequence_id].ids, "<u4").tolist()
        assert whole[r.offset : r.offset + r.length] == ids == want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == crc(ids)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(ids)
    assert got == {i: len(ids) for i, ids in want.items()}
    assert sum(len(r.ids) for r in held.values()) == 4 * sum(got.values())
    packed.unpersist()
