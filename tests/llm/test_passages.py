"""Passage removal and importance resampling against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from loadmason.llm import importance, substring_dedup
from loadmason.llm.importance import bucket_counts, collapsed, draw, gram_counts, patterns, resample
from loadmason.llm.shared_keys import narrow, wide
from loadmason.llm.substring_dedup import remove_repeats, rolling_hashes

from .conftest import DOCUMENT, clashing, sentence
from .plain import words


def plain_removal(rows, size):
    """The words that stay of each row, and the intervals that go."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, math.inf), math.inf if doc is None else doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (math.inf if doc is None else doc):
                gone |= set(range(i, i + size))
        spans = [(a, next(b for b in range(a, len(w) + 1) if b not in gone)) for a in sorted(gone) if a - 1 not in gone]
        out.append((doc, len(w), len(gone), spans, b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def found_removal(docs, size):
    return sorted([(r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.spans], r.text) for r in remove_repeats(docs, size).collect()], key=repr)


def passages():
    """Documents that share passages, in any order, some under one id."""
    rng = random.Random(11)
    shared = [sentence(rng, n, 50) for n in (3, 4, 5, 13, 14, 30)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(0, 15), 50) for _ in range(3)] + rng.sample(shared, 2)
        rng.shuffle(parts)
        rows.append((rng.randrange(40), "  \n".join(parts)))
    return [*rows, (None, shared[5]), (None, shared[5] + " more"), (7, None), (3, ""), (-5, shared[4]), (2, "ü " * 40), (9, "ü " * 40)]


@pytest.mark.parametrize("size", [1, 4, 13])
@pytest.mark.parametrize("small", [False, True])
def test_repeated_passages_go(spark, monkeypatch, size, small):
    if small:  # several bundles a slice, several slices, many buckets
        for name, value in (("BUNDLE_BYTES", 300), ("SLICE_BYTES", 900), ("BUCKET_BYTES", 500)):
            monkeypatch.setattr(substring_dedup, name, value)
    rows = passages()
    docs = clashing(spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCUMENT).repartition(3))
    assert found_removal(docs, size) == plain_removal(rows, size)


def test_odd_texts_and_no_documents(odd_docs, odd_texts, no_docs):
    assert found_removal(odd_docs, 13) == plain_removal(list(enumerate(odd_texts)), 13)
    assert remove_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(no_docs, 0)


def test_hashes_roll():
    words_ = np.random.default_rng(1).integers(0, 1 << 63, 500, dtype=np.uint64)
    words_[300:320] = words_[100:120]
    found = rolling_hashes(words_, 13)
    assert len(found) == 488 and len(set(found.tolist())) == 480
    assert (found[300:308] == found[100:108]).all()
    assert not len(rolling_hashes(words_[:12], 13))


def test_sorted_hashes_are_packed():
    rng = np.random.default_rng(2)
    for keys in (rng.integers(0, 1 << 63, 5, dtype=np.uint64), rng.integers(0, 1 << 40, 1000, dtype=np.uint64), np.array([3], np.uint64)):
        keys = np.sort(keys)
        assert (wide(narrow(keys)) == keys).all()


def plain_grams(text, longest):
    w, now = [], b""
    for b in (text or "").encode().lower() + b" ":
        if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A:
            now += bytes([b])
        elif now:
            w.append(now)
            now = b""
    return w, [b" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, longest, buckets, min_words, percent, seed):
    counts = [Counter(zlib.crc32(g) % buckets for t in texts for g in plain_grams(t, longest)[1]) for texts in ([t for _, t in rows], target)]
    s, t = (sum(c.values()) for c in counts)
    gain = [math.floor(1000 * math.log((counts[1][b] + 1) * (s + buckets) / ((counts[0][b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        w, grams = plain_grams(text, longest)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in grams) // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(w)])
    able = sorted([r for r in out if r[4] >= min_words], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted([(*r[:4], rank.get(id(r))) for r in out], key=repr)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 50, 50)])
def test_resampling(spark, odd_docs, odd_texts, longest, buckets, percent):
    target = ["changed odd w1 w2 w3", None, "W7 w7-w7", "ünïcödé"]
    docs = clashing(odd_docs)
    got = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), longest, buckets, 20, percent, 5).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(list(enumerate(odd_texts)), target, longest, buckets, 20, percent, 5)


def test_ranks_go_on_over_partitions(spark):
    rows = [(i % 50 if i % 5 else None, f"same words {i % 3}", None, None, None) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCUMENT).repartition(7)
    target = spark.createDataFrame([("same",)], "text string")
    got = sorted((r for r in resample(docs, target, min_words=3, percent=60).collect() if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in got] == list(range(1, 241))
    order = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in got]
    assert order == sorted(order)


def test_drawn_documents_and_empty_tables(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("changed",)], "text string")
    drawn = draw(clashing(odd_docs), target, percent=50)
    want = {r.doc_id for r in resample(odd_docs, target, percent=50).where("rank IS NOT NULL").collect()}
    assert {r.doc_id for r in drawn.collect()} == want and drawn.columns == clashing(odd_docs).columns
    assert resample(no_docs, target).count() == 0
    assert resample(odd_docs, no_docs).count() == odd_docs.count()
    assert not bucket_counts(no_docs).any()


def test_spans_overlap():
    assert collapsed(b" A--b\tC\xc3\xa9!") == b"a b c\xc3\xa9"
    assert gram_counts(b"a b, a B", patterns(2)) == {b"a": 2, b"b": 2, b"a b": 2, b"b a": 1}
    assert importance.bucket_gains(np.array([0, 0]), np.array([0, 0])).tolist() == [0, 0]
