"""What a Python worker holds: the arrays of one slice, and nothing between tasks."""

import functools
import os
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadmason.llm import common, ngram_join, packing, quality, shared_keys, text_arrays, tiles

from .conftest import DOCUMENT, sentence


def peak(run):
    """The largest number of bytes that Python and numpy held meanwhile, and the result."""
    tracemalloc.start()
    try:
        found = run()
        return tracemalloc.get_traced_memory()[1], found
    finally:
        tracemalloc.stop()


def test_hashes_of_a_long_text_take_small_blocks():
    data = np.frombuffer(b"some words " * 100_000, np.uint8)
    start = np.arange(0, len(data), 5)
    most, found = peak(lambda: text_arrays.span_hashes(data, start, start + 4))
    assert most < 6 * found.nbytes
    # the same bytes have the same hash in every block, and a span may be longer than a block
    assert len(set(found.tolist())) == 11
    long = np.frombuffer(b"x" * (3 * text_arrays._BLOCK) + b"y", np.uint8)
    spans = text_arrays.span_hashes(np.concatenate([long, long]), np.array([0, len(long)]), np.array([len(long), 2 * len(long)]))
    assert spans[0] == spans[1]


def test_bitmaps_are_packed_one_by_one():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 50, 3000, *[20] * 200)]
    most, found = peak(lambda: ngram_join.bitmaps(sets, 1 << 16))
    assert most < 2 * found.nbytes
    plain = np.zeros((len(sets), 1 << 16), bool)
    for row, one in zip(plain, sets, strict=True):
        row[[int(v) % (1 << 16) for v in one]] = True
    assert (found == np.packbits(plain, axis=1).view(np.uint64)).all()


def test_a_slice_of_many_owners_is_dealt_whole():
    owners = np.arange(shared_keys.SLICE_OWNERS, dtype=np.int64) * 3 - 100_000
    keys = np.arange(len(owners), dtype=np.uint64) // np.uint64(2) << np.uint64(40)  # two neighbours share each
    rows = list(shared_keys._dealt(owners, keys, np.ones(len(owners), np.int64), 5))
    assert {r[0] for r in rows} <= {None, *range(5)}
    a, b = (np.frombuffer(x, np.int64) for x in rows[-1][2:])
    assert (np.sort(a) == owners[1::2]).all() and (a - b == 3).all()
    found = {}
    for _, packed, used, least in rows[:-1]:
        found |= dict(zip(shared_keys.wide(packed).tolist(), np.frombuffer(used, np.int64)[np.frombuffer(least, np.uint16)].tolist(), strict=True))
    assert found == dict(zip(keys[::2].tolist(), owners[::2].tolist(), strict=True))


@pytest.fixture
def given_back(tmp_path, monkeypatch):
    """A file that is there as soon as a task has given its memory back."""
    path = str(tmp_path / "given-back")
    monkeypatch.setattr(common, "give_back", functools.partial(open, path, "w"))
    return path


def test_tasks_over_keys_and_tiles_give_memory_back(spark, given_back, tmp_path):
    def is_given(df):
        rows = df.collect()
        there = os.path.exists(given_back)
        if there:
            os.rename(given_back, tmp_path / "before")
        return rows, there

    keyed = spark.createDataFrame([(1, [5, 6]), (2, [6]), (3, [7])], "owner long, keys array<long>")
    rows, there = is_given(shared_keys.shared_key_links(keyed))
    assert there and [(r.a, r.b) for r in rows] == [(2, 1)]
    tasks = F.array(F.struct(F.lit("1").alias("task"), F.lit(0).alias("side")))
    members = spark.createDataFrame([(1, 1, b"a"), (2, 1, b"b"), (3, 1, b"c")], "id long, weight long, payload binary").withColumn("tasks", tasks)
    rows, there = is_given(tiles.tile_links(members, lambda name, left, right: ~np.eye(len(left), dtype=bool)))
    assert there and sorted((r.id, r.links, r.root) for r in rows) == [(1, 2, 1), (2, 2, 1), (3, 2, 1)]
    pieces = spark.createDataFrame([(1, 0, 2, b"12345678", 2)], packing._PIECES)
    rows, there = is_given(packing.pack(pieces))
    assert there and [(r.doc_id, r.offset, r.length) for r in rows] == [(1, 0, 2)]


def test_no_stage_of_the_classifier_has_two_python_workers_a_core(spark, monkeypatch):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, sentence(rng, 30) + (" #|" * 40 if i % 2 else ""), "en", None, 0) for i in range(60)], DOCUMENT)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda labelled: seen.append(labelled._jdf.queryExecution().executedPlan().toString()) or fit(labelled))
    kept = {r.doc_id for r in quality.keep_good(docs, labels).collect()}
    assert len(seen) == 1 and "MapInArrow" not in seen[0]
    assert kept == {r.doc_id for r in quality.score_documents(docs, labels).where("predicted = 1").collect()}
    assert kept and len(kept) < 60
