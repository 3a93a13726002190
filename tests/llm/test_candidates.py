"""Candidates of the near-copy join: documents that only share passages do not become one group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadmason.llm import ngram_join
from loadmason.llm.common import park
from loadmason.llm.shared_keys import owner_groups, shared_key_links
from loadmason.llm.tiles import tile_roots

from . import plain
from .conftest import sentence


def test_shared_passages_make_no_large_group(spark, monkeypatch):
    rng = random.Random(5)
    passages = [sentence(rng, 40) for _ in range(4)]
    texts = [f"{sentence(rng, 60)} {passages[i % 4]} {passages[(i // 4) % 4]}" for i in range(80)]
    texts += [f"{t} more" for t in texts[:3]]
    seen, compared = [], ngram_join.tile_tasks
    monkeypatch.setattr(ngram_join, "tile_tasks", lambda members: seen.append(members.groupBy("grp").count().collect()) or compared(members))
    found = ngram_join.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), 5, 4, 5).collect()
    want = plain.jaccard(dict(enumerate(texts)), 5, 4, 5)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found} == want
    assert sum(links for *_, links in want.values()) == 6
    # the shared keys alone connect nearly all of them
    sets = ngram_join.shingle_sets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 4, 5)
    links = shared_key_links(sets.select(F.col("h1").alias("owner"), "keys")).select("a", "b").distinct().collect()
    assert max(map(len, _groups(links))) > 40
    assert len(seen) == 1 and max(r["count"] for r in seen[0]) < 10


def _groups(links):
    at = {}
    for a, b in links:
        joined = at.get(a, {a}) | at.get(b, {b})
        at.update(dict.fromkeys(joined, joined))
    return list(at.values())


@pytest.mark.parametrize("num,den", [(9, 10), (4, 5), (1, 2)])
def test_bitmaps_lose_no_link(monkeypatch, num, den):
    rng = np.random.default_rng(num)
    for most in (1 << 15, 64):
        monkeypatch.setattr(ngram_join, "SKETCH_BITS", most)
        for _ in range(40):
            base = rng.integers(0, 1 << 63, int(rng.integers(1, 150)), dtype=np.uint64)
            sets = [np.unique(np.concatenate([base[rng.random(len(base)) < p], rng.integers(0, 1 << 63, 3, dtype=np.uint64)])) for p in rng.random(12)]
            roots = ngram_join.near_roots(np.array([len(s) for s in sets]), [ngram_join.sketch(s) for s in sets], num, den)
            assert (roots <= np.arange(len(sets))).all() and (roots[roots] == roots).all()
            for i, a in enumerate(sets):
                for j, b in enumerate(sets[:i]):
                    both = len(np.intersect1d(a, b))
                    assert roots[i] == roots[j] or den * both < num * (len(a) + len(b) - both)
    apart = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(30)]
    monkeypatch.setattr(ngram_join, "SKETCH_BITS", 1 << 15)
    assert (ngram_join.near_roots(np.full(30, 200), [ngram_join.sketch(s) for s in apart], 4, 5) == np.arange(30)).all()


def test_owners_that_share_many_keys_are_one_group(spark):
    rows = [(1, [*range(50)]), (2, [*range(50)]), (3, [*range(25), 99]), (4, [99, 77]), (4, [99]), (5, [66])]
    links = park(shared_key_links(spark.createDataFrame(rows, "owner long, keys array<long>").repartition(2)), "links")
    found = {}
    for r in owner_groups(links).collect():
        found.setdefault(r.grp, []).append(r.owner)
    assert sorted(map(sorted, found.values())) == [[1, 2], [1, 2, 3], [3, 4]]


@pytest.mark.parametrize("rows", [4096, 3])
def test_blocks_of_a_group_are_connected(spark, rows):
    # sizes that differ by one are connected, and no other pairs
    def connect(sizes, payloads):
        assert [int(p) for p in payloads] == sizes.tolist()
        order, root = np.argsort(sizes, kind="stable"), np.arange(len(sizes))
        for a, b in zip(order[:-1], order[1:], strict=True):
            if sizes[b] - sizes[a] <= 1:
                root[b] = root[a]
        return root

    members = [(g, 20, 100 * g + i, i) for g in (1, 2) for i in [*range(8), *range(10, 20)]] + [(3, 1, 300, 0)]
    df = spark.createDataFrame(members, "grp long, n long, id long, size long").withColumn("payload", F.col("size").cast("string").cast("binary"))
    found = [(r.id, r.root) for r in tile_roots(df.repartition(5), connect, rows).collect()]
    assert all(a != b for a, b in found)
    tops = plain.groups([m[2] for m in members], found)
    want = {100 * g + i: 100 * g + (0 if i < 8 else 10) for _, (g, i) in enumerate((m[0], m[3]) for m in members)}
    assert {i: top for i, (top, _) in tops.items()} == want
