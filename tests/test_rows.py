import pytest
from conftest import rows
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.functions.digests import md5_base64, md5_bytes, md5_uuid
from loadmason.operators.rows import differing, fingerprint


def test_align_by_position(spark):
    df = spark.sql("select 1 as z, 'a' as y")
    assert lm.align_by_position(df, "a INTEGER, b STRING").columns == ["a", "b"]
    with pytest.raises(lm.SchemaMismatch):
        lm.align_by_position(df, "a INTEGER")


def test_row_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, b"x"), (3, b"y")], "a int, b binary")
    right = spark.createDataFrame([(1, None), (2, b"x"), (4, b"y"), (4, b"y")], "p int, q binary")
    assert rows(lm.row_diff(left, right)) == [(1, None, "left", 1), (3, b"y", "left", 1), (4, b"y", "right", 2)]
    assert lm.row_diff(left, left).count() == 0


def test_key_diff(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", 4), (5, "e", 5), (5, "f", 6)], "k int, v string, n int")
    right = spark.createDataFrame([(1, "a", 1), (2, "B", 2), (3, "c", 3), (6, "g", 6), (5, "e", 7)], "k int, v string, n int")
    assert rows(lm.key_diff(left, right, ["k"])) == [
        (2, "changed", "v", 1, 1), (3, "changed", "n", 1, 1), (4, "removed", None, 1, 0), (5, "changed", None, 2, 1), (6, "added", None, 0, 1)]


def test_fingerprint_sees_null_position_and_table(spark):
    df = spark.sql("select * from values (1, cast(null as int)), (cast(null as int), 1), (1, 1) t(a, b)")
    one = [r[0] for r in df.select(fingerprint([F.col("a"), F.col("b")], "t")).collect()]
    two = [r[0] for r in df.select(fingerprint([F.col("a"), F.col("b")], "u")).collect()]
    assert len(set(one + two)) == 6
    assert lm.row_fingerprint(df, "t").columns == ["a", "b", "fingerprint"]


def test_digests(spark):
    df = spark.sql("select 'x' s, binary('x') b, cast(null as string) n")
    row = df.select(md5_bytes("s"), md5_base64("s"), md5_uuid("s"), md5_base64("b"), md5_bytes("n"), md5_base64("n"), md5_uuid("n")).head()
    assert bytes(row[0]).hex() == "9dd4e461268c8034f5c8564e155c67a6"
    assert row[1] == row[3] == "ndTkYSaMgDT1yFZOFVxnpg=="
    assert row[2] == "9dd4e461-268c-8034-f5c8-564e155c67a6"
    assert tuple(row[4:]) == (None, None, None)


def test_staged_rows_come_back(spark, tmp_path):
    from datetime import datetime

    target = "a INTEGER, b BIGINT, c FLOAT, d STRING, e TIMESTAMP, f VARBINARY"
    data = [(1, 2, 3.33, "record", datetime(2024, 1, 1), b"bytes"), (2, 2, None, "record", None, b"bytes")]
    df = spark.createDataFrame(data, "fi int, fl bigint, fd double, fs string, ft timestamp, fb binary")
    lm.write_staged(df, str(tmp_path / "s"), target)
    back = lm.read_staged(spark, str(tmp_path / "s"), target)
    assert rows(back) == rows(df) and back.columns == list("abcdef")
    assert all(not f.metadata for f in back.schema)


@pytest.mark.parametrize("other", ["a INTEGER", "a INTEGER, b STRING, c STRING", "a STRING, b INTEGER"])
def test_staged_signature_must_match(spark, tmp_path, other):
    lm.write_staged(spark.sql("select 1 a, 'x' b"), str(tmp_path / "s"))
    with pytest.raises(lm.SignatureMismatch):
        lm.read_staged(spark, str(tmp_path / "s"), other)


def test_unstamped_files_are_refused(spark, tmp_path):
    df = spark.sql("select 1 a, 'x' b")
    df.write.parquet(str(tmp_path / "s"))
    with pytest.raises(lm.SignatureMismatch):
        lm.read_staged(spark, str(tmp_path / "s"), df.schema)


def test_staging_checks_its_rows(spark, tmp_path):
    df = spark.sql("select 1 a, 'x' b")
    for target in ("a INTEGER", "a STRING, b INTEGER"):
        with pytest.raises(lm.SchemaMismatch):
            lm.write_staged(df, str(tmp_path / "s"), target)
    with pytest.raises(ValueError):
        lm.write_staged(df, str(tmp_path / "s"), mode="append")


@pytest.mark.parametrize("levels", [1, 2])
def test_digests_give_the_same_differences(spark, levels):
    data = [(i % 40 if i % 9 else None, f"v{i % 7}", i / 2) for i in range(300)] * 2
    left = spark.createDataFrame(data, "k int, v string, x double").repartition(3)
    right = spark.createDataFrame([*data[5:], (3, "new", None), (None, None, -0.0), (3, "new", None)], "k int, v string, x double")
    assert rows(lm.key_diff(left, right, ["k"], digest_levels=levels)) == rows(lm.key_diff(left, right, ["k"]))
    assert lm.key_diff(left, left, ["k", "v"], digest_levels=levels).count() == 0


def test_digests_leave_out_most_shared_rows(spark):
    left = spark.range(50_000).select("id", (F.col("id") % 3).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 777, 9).otherwise(F.col("v")))
    one, two = (differing(left, right, ["id"], levels) for levels in (1, 2))
    assert 1 <= one[0].count() < 60 and one[0].count() == one[1].count()
    assert 1 <= two[0].count() <= 3
    plan = one[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(lm.key_diff(left, right, ["id"], digest_levels=2)) == [(777, "changed", "v", 1, 1)]
