"""The pivot index, tiles and components against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadmason.llm import pivot_dedup
from loadmason.llm.components import components
from loadmason.llm.pivot_dedup import link_vectors, nearest_pivots, spread_out
from loadmason.llm.tiles import tile_links, tile_tasks

from . import plain
from .conftest import clashing


def brute(vectors, cosine=0.95):
    """Links and components of {id: vector}; unusable vectors are linked with nothing."""

    def fit(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    usable = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vectors.items() if fit(v)}
    ids = sorted(usable)
    pairs = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= cosine
    ]
    return {i: (links, top, top == i) for i, (top, links) in plain.groups(list(vectors), pairs).items()}


def clusters(rng, n, size=16):
    centres = rng.normal(size=(n // 8, size))
    out = [c + rng.normal(size=size) * rng.choice([0.02, 0.1, 0.3]) for c in centres for _ in range(6)]
    out += [rng.normal(size=size) for _ in range(n - len(out))]
    return [v.astype(np.float32).tolist() for v in out]


def found_links(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in frame.collect()}


@pytest.mark.parametrize("block_rows", [512, 6])
def test_links_are_those_of_all_pairs(spark, monkeypatch, block_rows):
    tasks = pivot_dedup.tile_tasks
    monkeypatch.setattr(pivot_dedup, "tile_tasks", lambda members: tasks(members, rows=block_rows))
    rng = np.random.default_rng(6)
    vectors = dict(enumerate(clusters(rng, 300)))
    hot = vectors[0]
    for i in range(300, 400):  # a quarter of all rows is one vector, more are near it
        vectors[i] = hot if i % 2 else (np.array(hot) + rng.normal(size=16) * 0.05).tolist()
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    odd += [[1e300] * 16, [1e-300] * 16, [1.0, 0.0], [2.0, 0.0], [0.0, 1.0], [5.0]]
    vectors.update({400 + i: v for i, v in enumerate(odd)})
    rows = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int")
    found = found_links(link_vectors(clashing(rows.repartition(3))))
    want = brute({i: [x / 1e150 for x in v] if v and v[0] == 1e300 else v for i, v in vectors.items()} | {407: [1.0] * 16})
    true = sum(n for n, _, _ in want.values())
    assert len(found) == len(vectors)
    assert all(found[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _, _ in found.values()) >= 0.98 * true
    assert all(found[i] == (0, i, True) for i in range(400, 406))
    assert found[408][0] == found[409][0] == 1 and found[409][1] == 408 and found[410][0] == found[411][0] == 0


@pytest.mark.parametrize("long_list", [0, 10])
def test_long_lists_go_by_pairs(spark, monkeypatch, long_list):
    """The same links from lists of pairs of pivots, or from some of either kind."""
    rng = np.random.default_rng(9)
    vectors = dict(enumerate(clusters(rng, 200)))
    rows = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(3)
    want = found_links(link_vectors(rows))
    monkeypatch.setattr(pivot_dedup, "LONG_LIST", long_list)
    assert found_links(link_vectors(rows)) == want


@pytest.mark.parametrize("size", [16, 64])
@pytest.mark.parametrize("count", [200, pivot_dedup.MAX_PIVOTS])
def test_recall_of_the_index(size, count):
    """Pairs just near enough, among random pivots, up to as many as there can be: they must share enough of the nearest."""
    rng = np.random.default_rng(size + count)

    def unit(n):
        x = rng.normal(size=(n, size))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    pivots, one, other = unit(count), unit(600), unit(600)
    other -= (one * other).sum(1, keepdims=True) * one
    two = 0.951 * one + np.sqrt(1 - 0.951**2) * other / np.linalg.norm(other, axis=1, keepdims=True)
    a, b = (nearest_pivots(x, pivots, pivot_dedup.NEAREST) for x in (one, two))
    found = [len(set(x) & set(y)) >= pivot_dedup.SHARED for x, y in zip(a.tolist(), b.tolist())]
    assert np.mean(found) >= 0.95


def test_recall_among_many_clusters(spark):
    rng = np.random.default_rng(12)
    vectors = dict(enumerate(clusters(rng, 900)))
    want = brute(vectors)
    rows = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(4)
    found = found_links(link_vectors(rows))
    true = sum(n for n, _, _ in want.values())
    assert true > 500 and 0.98 * true <= sum(n for n, _, _ in found.values()) <= true


def test_rows_that_repeat_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    rows = spark.createDataFrame([(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.0]), (7, [1.0, 0.1]), (9, [0.0, 1.0])], schema)
    assert sorted(map(repr, map(tuple, link_vectors(rows).collect()))) == sorted(
        map(repr, [(3, 2, 3, True), (3, 2, 3, True), (None, 0, None, True), (7, 2, 3, False), (9, 0, 9, True)])
    )
    assert link_vectors(spark.createDataFrame([], schema)).count() == 0


def test_an_id_with_several_vectors(spark):
    rng = np.random.default_rng(4)
    unlike = np.eye(6, 16)
    rows = [(5, v.tolist()) for v in unlike] + [(10 + i, (v + rng.normal(size=16) * 0.01).tolist()) for i, v in enumerate(unlike)]
    rows += [(5, None), (2, unlike[3].tolist()), (40, np.eye(16)[9].tolist())]
    found = link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    assert len(found) == len(rows)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found}
    assert got == {(5, 7, 2, False), (2, 2, 2, True), (13, 2, 2, False), (40, 0, 40, True)} | {(10 + i, 1, 2, False) for i in range(6) if i != 3}


def test_pivots():
    rng = np.random.default_rng(8)
    unit = rng.normal(size=(200, 5))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    pivots = spread_out(unit)
    similar = pivots @ pivots.T - 2 * np.eye(len(pivots))
    assert similar.max() < pivot_dedup.PIVOT_COSINE
    assert ((unit @ pivots.T).max(axis=1) >= pivot_dedup.PIVOT_COSINE - 1e-12).all()
    order = nearest_pivots(unit, pivots, 4)
    assert (order == np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :4]).all()


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "path": [(i, i + 1) for i in rng.sample(range(80), 80) if i != 40],
        "star": [(500, i) for i in range(100)] + [(i, i) for i in range(90, 110)],
        "none": [(4, 4), (None, 1)],
    }[kind]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    linked = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    want = plain.groups(sorted(linked), [e for e in edges if None not in e and e[0] != e[1]])
    assert found == {i: top for i, (top, _) in want.items()}


def test_tiles_compare_every_pair_once(spark):
    """Members of a group are linked if they differ by one; bands are tens."""
    ids = [*range(0, 60), *range(100, 103)]
    members = spark.createDataFrame([(i, 1 if i < 100 else 2, i // 10, 8, i % 3 + 1) for i in ids], "id long, grp long, band int, bytes long, weight long")
    tasks = tile_tasks(members, rows=4).withColumn("payload", F.col("id").cast("string").cast("binary"))

    def link(_, left, right):
        a = np.array([int(x) for x in left])
        b = a if right is None else np.array([int(x) for x in right])
        return np.abs(a[:, None] - b[None, :]) == 1

    found = tile_links(tasks, link).groupBy("id").agg(F.sum("links").alias("links"))
    weight = {i: i % 3 + 1 for i in ids}
    want = {i: sum(weight.get(j, 0) for j in (i - 1, i + 1)) for i in ids}
    assert {r.id: r.links for r in found.collect()} == want
    counts = tasks.select(F.explode("tasks.task").alias("task")).groupBy("task").count()
    assert counts.agg(F.max("count")).head()[0] < 20
