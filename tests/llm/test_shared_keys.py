"""Links by shared keys, and the filter that keeps rows out of a shuffle, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from loadmason.llm import shared_keys, token_files
from loadmason.llm.common import park, release
from loadmason.llm.components import components
from loadmason.llm.line_runs import delete_copies
from loadmason.llm.ngram_join import keep_one
from loadmason.llm.shared_keys import KeyFilter, free_names, shared_key_links

from . import plain
from .conftest import DOCUMENT, clashing, sentence


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (40, 50)])
def test_owners_of_a_key_are_connected(spark, monkeypatch, sizes):
    monkeypatch.setattr(shared_keys, "SLICE_KEYS", sizes[0])
    monkeypatch.setattr(shared_keys, "BUCKET_KEYS", sizes[1])
    rng = random.Random(3)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), [rng.getrandbits(63) * rng.choice([1, -1]) for _ in range(rng.randrange(0, 9))]) for _ in range(120)]
    common = [rng.getrandbits(63) for _ in range(12)]
    rows = [(o, [*keys, *rng.sample(common, rng.randrange(0, 2))]) for o, keys in rows]
    rows += [(o, list(keys)) for o, keys in rows[:30]]  # owners with several rows
    found = [(r.a, r.b) for r in shared_key_links(spark.createDataFrame(rows, "owner long, keys array<long>").repartition(4)).collect()]
    owners = {}
    for o, keys in rows:
        for k in keys:
            owners.setdefault(k, set()).add(o)
    pairs = [(min(x), o) for x in owners.values() for o in x if o != min(x)]
    assert all(a > b for a, b in found)
    everyone = sorted({o for o, _ in rows})
    assert {i: top for i, (top, _) in plain.groups(everyone, found).items()} == {i: top for i, (top, _) in plain.groups(everyone, pairs).items()}


def test_no_keys(spark):
    assert shared_key_links(spark.createDataFrame([(1, []), (2, [])], "owner long, keys array<long>")).count() == 0
    assert shared_key_links(spark.createDataFrame([], "owner long, keys array<long>")).count() == 0


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_the_filter_keeps_all_listed_rows(spark, monkeypatch, most):
    monkeypatch.setattr(shared_keys, "MOST_BITS", most)
    listed = spark.range(0, 9000, 3).select(F.col("id").alias("k"))
    df = spark.range(10_000).select("id", F.lit("x").alias("at"), F.lit("y").alias("row"))
    some, rest = KeyFilter(listed, "test").split(df, F.col("id"))
    kept = {r.id for r in some.collect()}
    assert kept >= set(range(0, 9000, 3)) and some.columns == df.columns
    assert kept | {r.id for r in rest.collect()} == set(range(10_000)) and some.count() + rest.count() == 10_000
    assert most < 1 << 20 or len(kept) < 3500
    none, everything = KeyFilter(listed.where("k < 0"), "test").split(df, F.col("id"))
    assert none.count() == 0 and everything.count() == 10_000


def test_names_are_free(spark):
    assert free_names(spark.sql("select 1 as At, 2 as at_"), "at", "at", "row") == ["at__", "at___", "row"]


def test_rounds_leave_nothing_behind(spark, tmp_path, monkeypatch):
    from loadmason.llm import common

    made = []
    monkeypatch.setattr(common, "new_path", lambda spark, label: made.append(str(tmp_path / f"{label}-{len(made)}")) or made[-1])
    found = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long"))
    assert found.where("component = 0").count() == 41
    assert len(made) > 10 and sum((tmp_path / p.rsplit("/", 1)[1]).exists() for p in made) == 1
    parked = park(spark.range(3), "x")
    release(parked)
    assert not (tmp_path / parked.parked_at.rsplit("/", 1)[1]).exists()


def test_columns_of_any_name_and_kind(spark):
    rng = random.Random(8)
    text = sentence(rng, 60)
    near = text.replace("w1 ", "changed ", 1)
    lines = "a line of five words\nanother line of five words"
    rows = [(1, text), (2, near), (3, text), (3, text), (4, None), (5, lines), (6, f"own words\n{lines}"), (None, lines)]
    docs = clashing(spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], DOCUMENT))
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.where("doc_id < 5").collect()) == [1, 4]
    shorter = delete_copies(docs)
    assert shorter.columns == docs.columns and shorter.count() == len(rows)
    assert {r.text for r in shorter.where("doc_id = 6").collect()} == {"own words"}
    assert {r.extras["a"] for r in [*kept.collect(), *shorter.collect()]} == {1}


def test_rows_of_one_id_are_dealt_over_tasks(spark):
    rows = [(7 if i % 3 == 0 else i, f"text {i}", None, None, None) for i in range(3000)]
    folder = park(spark.range(1), "unused").parked_at + "-tokens"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(spark.createDataFrame(rows, DOCUMENT), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(f"{folder}/shards")
    per_part = {r.part: r.n for r in shards.groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).collect()}
    assert sum(per_part.values()) == 3000 and max(per_part.values()) < 1200
    starts = sorted((r.start, r.n_tokens) for r in token_files.read_token_files(spark, folder).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts[:-1], starts[1:], strict=True))
