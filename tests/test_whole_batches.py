"""Batches that are full although many tasks write them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.operators.batches import whole_batches
from loadmason.session import list_files, move_files, new_path

from conftest import rows


@pytest.mark.parametrize("n", [0, 1, 299, 300, 301, 5000])
def test_all_files_but_one_are_full(spark, table, n):
    """as many files of each size as one task would write, from several tasks."""
    name, path = table("k BIGINT, v STRING"), new_path(spark, "rows")
    given = spark.range(n, numPartitions=7).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"))
    given.where("id % 11 <> 5 or id > 400").unionAll(given.where("id % 11 = 5 and id <= 400")).write.parquet(path)
    lm.store(whole_batches(spark.read.parquet(path), 300), name, batch_size=0)
    sizes = Counter(r["n"] for r in spark.table(name).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n")).collect())
    assert sizes == Counter([300] * (n // 300) + [n % 300] * (n % 300 > 0))
    assert rows(spark.table(name)) == rows(given)


def test_files_are_moved_by_few_calls(spark, tmp_path):
    """what is the same for all files is asked for once, and a second attempt changes nothing."""
    source, goal = tmp_path / "from" / "p=a, b", tmp_path / "to"
    source.mkdir(parents=True)
    for i in range(50):
        (source / f"f{i}").write_text(str(i))
    (source / "_hidden").write_text("")
    names = list_files(spark, str(tmp_path / "from"))
    assert sorted(names) == sorted(f"p=a, b/f{i}" for i in range(50)) and list_files(spark, str(goal)) == []
    moves = [(f"{tmp_path}/from/{name}", f"{goal}/{name.rpartition('/')[2]}") for name in names]
    client, calls = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    client.send_command = lambda *args, **options: calls.append(args) or send(*args, **options)
    try:
        move_files(spark, moves, 4)
    finally:
        client.send_command = send
    assert len(calls) < 50 * 8
    move_files(spark, moves, 4)
    assert {f.name: f.read_text() for f in goal.iterdir() if not f.name.startswith(".")} == {f"f{i}": str(i) for i in range(50)}
    with pytest.raises(OSError):
        move_files(spark, [(f"{tmp_path}/from/none", f"{goal}/none")], 1)
