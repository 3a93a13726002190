import glob
import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.operators import keys as keys_module
from loadmason.operators.faults import effective_limit
from loadmason.plans import load as load_module
from loadmason.plans.sinks import JdbcSink, TableSink, effective_batch_size
from loadmason.session import new_path, shared_dir

THINGS = "fi INTEGER, fl BIGINT, fd FLOAT, fs STRING, ft TIMESTAMP, fb VARBINARY"
NOW = datetime(2024, 5, 1)
KV = "k INTEGER, v STRING"


def things(spark, n, start=0):
    data = [
        (-i, i << 33, i / 8, f"bird {i % 17}", NOW - timedelta(seconds=i), bytes([i % 251, 7]))
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(data, "a int, b bigint, c double, d string, e timestamp, f binary")


def kv(spark, data):
    return spark.createDataFrame(data, "k int, v string")


def stage_folders(spark):
    return set(glob.glob(f"{shared_dir(spark).replace('file:', '')}/loadmason/load-*"))


@pytest.mark.parametrize("options", [{"partition_by": ["v"]}, {"bucket_by": ["k"], "buckets": 2}])
def test_rows_are_counted_after_they_are_gathered(spark, table, options):
    name = table(KV, **options)
    report = lm.load(spark.range(100).select(F.col("id").cast("int"), (F.col("id") % 3).cast("string")), name)
    assert report.loaded == 100 and spark.table(name).count() == 100
    if "partition_by" in options:
        assert len(spark.table(name).inputFiles()) == 3


def test_append_twice(spark, table):
    name = table(THINGS)
    assert lm.load(things(spark, 1000), name).loaded == 1000
    assert lm.load(things(spark, 10, 1000), name).loaded == 10
    assert rows(spark.table(name)) == rows(things(spark, 1010))


def test_a_few_faults_are_tolerated(spark, table):
    name, rejects = table("a INTEGER, b STRING"), new_path(spark, "rejects")
    number = F.col("id").cast("string")
    df = spark.range(700).select(F.when(F.col("id") % 100 == 3, F.lit("gull")).otherwise(number), number)
    report = lm.load(df, name, coerce="loose", on_error="reject", reject_path=rejects)
    assert (report.read, report.loaded, report.rejected) == (700, 693, 7)
    assert spark.table(name).count() == 693
    kept = spark.read.parquet(rejects)
    assert rows(lm.fault_by_cause(kept)) == [("a: string does not fit INTEGER", 7)]
    assert sorted(r.row_text for r in kept.collect()) == [f"gull|{n}" for n in sorted(str(100 * k + 3) for k in range(7))]


def test_too_many_faults_leave_the_target_alone(spark, table):
    name = table("a INTEGER")
    lm.load(spark.createDataFrame([(1,)], "a int"), name)
    df = spark.range(600).select(F.when(F.col("id") % 8 == 0, F.lit("x")).otherwise(F.col("id").cast("string")).alias("a"))
    with pytest.raises(lm.LoadAborted, match="reached the maximum of allowable errors") as caught:
        lm.load(df, name, coerce="loose", on_error="reject")
    assert caught.value.report.rejected == 75
    assert rows(spark.table(name)) == [(1,)]
    assert spark.read.parquet(caught.value.report.reject_path).count() == 75


@pytest.mark.parametrize("faults,fails", [(9, False), (10, True), (11, True)])
def test_the_limit_itself_aborts(spark, table, faults, fails):
    df = spark.range(50).select(F.when(F.col("id") < faults, F.lit("x")).otherwise(F.lit("1")).alias("a"))
    name = table("a INTEGER")
    if fails:
        with pytest.raises(lm.LoadAborted):
            lm.load(df, name, coerce="loose", on_error="reject")
    else:
        assert lm.load(df, name, coerce="loose", on_error="reject").loaded == 50 - faults


def test_a_conversion_fault_ends_the_load_by_default(spark, table):
    name = table("a INTEGER")
    with pytest.raises(Exception, match="does not fit INTEGER"):
        lm.load(spark.createDataFrame([("1",), ("x",)], "a string"), name, coerce="loose")
    assert spark.table(name).count() == 0


def test_limits_and_batch_sizes():
    assert [effective_limit(v) for v in (None, 0, -5, 3, "7")] == [10, 10, 10, 3, 7]
    assert [effective_batch_size(v) for v in (None, 0, -1, 50, "50")] == [300, 300, 300, 50, 50]
    for wrong in (effective_limit, effective_batch_size):
        with pytest.raises(ValueError):
            wrong("many")


def test_append_with_keys(spark, table):
    name, rejects = table(KV), new_path(spark, "rejects")
    lm.load(kv(spark, [(1, "old"), (9, "old")]), name, keys=["k"])
    batch = kv(spark, [(1, "new"), (2, "b"), (2, "a"), (2, "a"), (3, "c"), (None, "n"), (None, "m")])
    report = lm.load(batch, name, keys=["k"], reject_path=rejects)
    assert (report.read, report.loaded, report.rejected) == (7, 3, 4)
    assert rows(spark.table(name)) == sorted([(1, "old"), (9, "old"), (2, "a"), (3, "c"), (None, "m")], key=repr)
    assert rows(spark.read.parquet(rejects).select("cause", "row_text")) == [
        ("key already in target", "1|new"), ("repeated key", "2|a"), ("repeated key", "2|b"), ("repeated key", "|n")]


def test_order_by_chooses_the_row(spark, table):
    data = spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "k int, v string, at int")
    first, last = table("k INTEGER, v STRING, at INTEGER"), table("k INTEGER, v STRING, at INTEGER")
    lm.load(data, first, keys=["k"], order_by=["at"])
    lm.load(data, last, mode="upsert", keys=["k"], order_by=["at"])
    assert rows(spark.table(first)) == [(1, "z", 1)]
    assert rows(spark.table(last)) == [(1, "a", 2)]


@pytest.mark.parametrize("layout", ["plain", "bucketed", "partitioned", "partitioned elsewhere"])
def test_upsert(spark, table, layout):
    options = {
        "plain": {}, "bucketed": {"bucket_by": ["k"], "buckets": 3}, "partitioned": {"partition_by": ["p"]},
        "partitioned elsewhere": {"partition_by": ["p"]},
    }[layout]
    name = table("k INTEGER, v STRING, p INTEGER", **options)
    keys = ["k", "p"] if layout == "partitioned" else ["k"]
    schema = "k int, v string, p int"
    lm.load(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", 3)], schema), name, mode="upsert", keys=keys)
    report = lm.load(spark.createDataFrame([(1, "b", 1), (1, "c", 1), (4, "b", 1)], schema), name, mode="upsert", keys=keys)
    assert (report.read, report.loaded, report.rejected) == (3, 3, 0)
    assert rows(spark.table(name)) == [(1, "c", 1), (2, "a", 2), (3, "a", 3), (4, "b", 1)]
    again = lm.load(spark.createDataFrame([(1, "c", 1), (4, "b", 1)], schema), name, mode="upsert", keys=keys)
    assert again.loaded == 2
    assert rows(spark.table(name)) == [(1, "c", 1), (2, "a", 2), (3, "a", 3), (4, "b", 1)]


def test_upsert_moves_a_row_to_another_partition(spark, table):
    name = table("k INTEGER, v STRING, p INTEGER", partition_by=["p"])
    schema = "k int, v string, p int"
    lm.load(spark.createDataFrame([(1, "a", 1), (2, "a", 2)], schema), name, mode="upsert", keys=["k"])
    lm.load(spark.createDataFrame([(1, "b", 7)], schema), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "b", 7), (2, "a", 2)]


def test_upsert_leaves_other_partitions_files_alone(spark, table):
    name = table("k INTEGER, v STRING, p INTEGER", partition_by=["p"])
    schema = "k int, v string, p int"
    lm.load(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", None)], schema), name, mode="upsert", keys=["k", "p"])
    folder = TableSink(spark, name).location.replace("file:", "")
    before = {p: os.listdir(f"{folder}/{p}") for p in ("p=2", "p=1")}
    lm.load(spark.createDataFrame([(1, "b", 1), (3, "b", None)], schema), name, mode="upsert", keys=["k", "p"])
    assert os.listdir(f"{folder}/p=2") == before["p=2"] and os.listdir(f"{folder}/p=1") != before["p=1"]
    assert rows(spark.table(name)) == [(1, "b", 1), (2, "a", 2), (3, "b", None)]


def test_columns_may_be_called_like_table_details(spark, table):
    name = table("Location STRING, Provider INTEGER", bucket_by=["Provider"], buckets=2)
    for value in ("a", "b"):
        lm.load(spark.createDataFrame([(value, 1)], "a string, b int"), name, mode="upsert", keys=["Provider"])
    assert rows(spark.table(name)) == [("b", 1)]


def test_upsert_over_a_target_with_repeated_keys(spark, table):
    name = table(KV)
    lm.load(kv(spark, [(1, "a"), (1, "b"), (2, "c")]), name)
    lm.load(kv(spark, [(1, "z")]), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "z"), (2, "c")]


def test_upsert_with_rejects(spark, table):
    name = table(KV)
    df = spark.createDataFrame([("1", "a"), ("x", "b"), ("1", "c")], "k string, v string")
    report = lm.load(df, name, mode="upsert", keys=["k"], coerce="loose", on_error="reject")
    assert (report.read, report.loaded, report.rejected) == (3, 2, 1)
    assert rows(spark.table(name)) == [(1, "c")]


def hot_rows(spark, n=3000):
    """One key holds a third of the rows, another group shares a few keys."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50 + 100).otherwise(F.col("id") + 1000).cast("int").alias("k"),
        F.col("id").cast("string").alias("v"),
    )


@pytest.mark.parametrize("broadcast_bytes", [keys_module.BROADCAST_BYTES, 800, 1])
def test_hot_key_rejects_are_whole(spark, table, monkeypatch, broadcast_bytes):
    """The same rejects whether keys are broadcast, split into hot and cold, or joined by shuffle."""
    monkeypatch.setattr(load_module, "BROADCAST_BYTES", broadcast_bytes)
    name, rejects = table(KV), new_path(spark, "rejects")
    lm.load(kv(spark, [(7, "x"), (120, "x")]), name)
    df = hot_rows(spark)
    report = lm.load(df, name, keys=["k"], max_errors=10**9, reject_path=rejects)
    first = df.groupBy("k").agg(F.min("v").alias("v")).filter(~F.col("k").isin(7, 120))
    assert report.loaded == first.count() and report.loaded + report.rejected == 3000
    assert rows(spark.table(name).filter("v <> 'x'")) == rows(first)
    loaded = spark.table(name).filter("v <> 'x'")
    left = df.exceptAll(loaded).select(F.concat_ws("|", F.col("k").cast("string"), "v"))
    kept = spark.read.parquet(rejects)
    assert rows(kept.select("row_text")) == rows(left)
    causes = dict(rows(lm.fault_by_cause(kept)))
    assert causes["key already in target"] == df.filter("k in (7, 120)").count()


def test_identical_rows_are_told_apart(spark, table):
    name, rejects = table(KV), new_path(spark, "rejects")
    report = lm.load(kv(spark, [(1, "a")] * 20), name, keys=["k"], max_errors=100, reject_path=rejects)
    assert (report.loaded, report.rejected) == (1, 19)
    assert spark.read.parquet(rejects).count() == 19


def test_key_only_table(spark, table):
    name = table("k INTEGER")
    lm.load(spark.createDataFrame([(1,), (1,), (2,)], "k int"), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1,), (2,)]


def test_stage_is_removed(spark, table):
    before = stage_folders(spark)
    name = table(KV)
    lm.load(kv(spark, [(1, "a")]), name, keys=["k"])
    with pytest.raises(lm.LoadAborted):
        lm.load(kv(spark, [(1, "a")] * 30), name, keys=["k"])
    assert stage_folders(spark) == before


def test_an_empty_batch(spark, table):
    name = table(KV)
    for options in ({}, {"keys": ["k"]}, {"mode": "upsert", "keys": ["k"]}, {"on_error": "reject"}):
        report = lm.load(kv(spark, []), name, **options)
        assert (report.read, report.loaded, report.rejected) == (0, 0, 0)


@pytest.mark.parametrize("options", [
    {"mode": "replace"}, {"mode": "upsert"}, {"keys": ["nope"]}, {"order_by": ["nope"]}, {"on_error": "ignore"}, {"coerce": "lenient"},
])
def test_bad_options(spark, table, options):
    with pytest.raises(ValueError):
        lm.load(kv(spark, [(1, "a")]), table(KV), **options)


def test_store_is_strict(spark, table):
    name = table(THINGS)
    source = things(spark, 3).toDF("whole", "long", "real", "text", "at", "bytes")
    lm.store(source, name)
    assert rows(spark.table(name)) == rows(source)
    with pytest.raises(lm.SchemaMismatch):
        lm.store(spark.sql("select 1L, 2L, 3D, '4', timestamp'1970-01-01', binary('x')"), name)


def test_insert_exact(spark, table):
    name = table(THINGS)
    source = spark.createDataFrame(
        [(-4, 5, 0.75, "\\N", NOW.replace(microsecond=8765), b"\xfe"), (None,) * 6], "a int, b bigint, c double, d string, e timestamp, f binary"
    )
    lm.insert_exact(source, name)
    want = [(-4, 5, 0.75, "\\N", NOW.replace(microsecond=8000), b"\xfe"), (None,) * 6]
    assert rows(spark.table(name)) == sorted(want, key=repr)
    with pytest.raises(lm.SchemaMismatch):
        lm.insert_exact(source.withColumn("a", F.col("a").cast("bigint")), name)


def test_max_records_per_file(spark, table):
    name = table(KV)
    lm.load(spark.range(100).select(F.col("id").cast("int"), F.lit("x")).coalesce(1), name, max_records_per_file=10)
    assert len(spark.table(name).inputFiles()) == 10
    assert spark.conf.get("spark.sql.files.maxRecordsPerFile") == "0"


def test_load_file(spark, table, tmp_path):
    (tmp_path / "in").write_text("1\ta\n2\tb\nx\tc\n3\n")
    name = table(KV)
    report = lm.load_file(spark, str(tmp_path / "in"), name, on_error="reject")
    assert (report.read, report.loaded, report.rejected) == (4, 2, 2)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert rows(spark.read.parquet(report.reject_path).select("row_text")) == [("3",), ("x\tc",)]


def test_fault_helpers(spark):
    rejects = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "cause string, row_text string")
    assert rows(lm.fault_by_cause(rejects)) == [("a", 2), ("b", 1)]
    assert lm.fault_sample(rejects, 2).count() == 2
    assert lm.reached_limit(rejects, 3) and not lm.reached_limit(rejects, 4) and not lm.reached_limit(rejects)
    assert rows(lm.fault_limit(rejects, 3)) == [(3, 3, True)]


def test_jdbc_options(spark, monkeypatch):
    """No database here: only the settings handed to Spark's JDBC source are looked at."""
    monkeypatch.setattr(JdbcSink, "rows", lambda self: self.spark.createDataFrame([], "a int, b string"))
    sink = JdbcSink(spark, "jdbc:x:y", "t", batch_size=50, user="u", isolationLevel="NONE")
    assert sink.options == {"url": "jdbc:x:y", "dbtable": "t", "batchsize": "50", "user": "u", "isolationLevel": "NONE"}
    assert sink.target.types == ["INTEGER", "STRING"]
    assert JdbcSink(spark, "jdbc:x:y", "t").options["batchsize"] == "300"
    with pytest.raises(lm.TargetMissing):
        JdbcSink(spark, "jdbc:x:y", " ")
    written = []
    monkeypatch.setattr(JdbcSink, "append", lambda self, frame, seen=None: written.extend(frame.collect()))
    monkeypatch.setattr(JdbcSink, "rows", lambda self: self.spark.createDataFrame([(1, "x")], "a int, b string"))
    report = lm.load_jdbc(kv(spark, [(1, "a"), (2, "b")]), "jdbc:x:y", "t", keys=["a"])
    assert (report.loaded, report.rejected) == (1, 1) and [tuple(r) for r in written] == [(2, "b")]


P = "k int, v string, p string"


def test_a_failed_write_leaves_a_partitioned_table_as_it_was(spark, table, monkeypatch):
    name = table("k INTEGER, v STRING, p STRING", partition_by=["p"])
    lm.load(spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], P), name)
    batch = spark.createDataFrame([(1, "b", "y")], P)
    gathered = TableSink._gathered

    def failing(self, rows):
        return rows.withColumn("v", F.raise_error(F.lit("the disk is full")).cast("string"))

    monkeypatch.setattr(TableSink, "_gathered", failing)
    with pytest.raises(Exception, match="the disk is full"):
        lm.load(batch, name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "a", "x"), (2, "a", "y")]
    monkeypatch.setattr(TableSink, "_gathered", gathered)
    lm.load(batch, name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "b", "y"), (2, "a", "y")]


@pytest.mark.parametrize("value", ["it's", "a b:c/d%", "ü", None, "\\"])
def test_partitions_that_lose_all_rows_are_dropped(spark, table, value):
    name = table("k INTEGER, v STRING, p STRING", partition_by=["p"])
    lm.load(spark.createDataFrame([(1, "a", value), (2, "a", "y"), (3, "a", "z")], P), name)
    folder = TableSink(spark, name).location.replace("file:", "")
    kept = os.listdir(f"{folder}/p=z")
    lm.load(spark.createDataFrame([(1, "b", "y")], P), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "b", "y"), (2, "a", "y"), (3, "a", "z")]
    assert len(spark.sql(f"SHOW PARTITIONS {name}").collect()) == 2
    assert sorted(f for f in os.listdir(folder) if f.startswith("p=")) == ["p=y", "p=z"]
    assert os.listdir(f"{folder}/p=z") == kept


def test_old_versions_go(spark, table):
    name = table(KV)
    base = TableSink(spark, name).location.replace("file:", "")
    for number in range(5):
        lm.load(kv(spark, [(1, str(number))]), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name)) == [(1, "4")]
    assert len(glob.glob(f"{base}__v_*")) == 2 and not os.path.exists(base)
    lm.load(kv(spark, [(2, "x")]), name, mode="upsert", keys=["k"], keep_versions=1)
    assert len(glob.glob(f"{base}__v_*")) == 1
    assert rows(spark.table(name)) == [(1, "4"), (2, "x")]


def test_versions_and_rejects_stay_beside_the_table(spark):
    folder = new_path(spark, "my__v_tables")
    lm.create_table(spark, "beside", KV, location=f"{folder}/t")
    try:
        for number in range(3):
            lm.load(kv(spark, [(1, str(number))]), "beside", mode="upsert", keys=["k"])
            sink = TableSink(spark, "beside")
            assert sink.location.startswith(sink.base_location) and sink.base_location.endswith(f"{folder}/t")
            assert sink.default_reject_path().endswith(f"{folder}/t_rejects")
    finally:
        spark.sql("DROP TABLE beside")


def test_bucketed_on_a_part_of_the_key(spark, table):
    name = table("c STRING, k INTEGER, v STRING", bucket_by=["c"], buckets=3)
    schema = "c string, k int, v string"
    old = [(c, k, "old") for c in ("a", "b") for k in range(50)]
    lm.load(spark.createDataFrame(old, schema), name)
    lm.load(spark.createDataFrame([("a", k, "new") for k in range(25, 75)], schema), name, mode="upsert", keys=["c", "k"])
    want = [("a", k, "old" if k < 25 else "new") for k in range(75)] + [("b", k, "old") for k in range(50)]
    assert rows(spark.table(name)) == sorted(want, key=repr)


def test_keys_are_stored_as_they_are(spark, table):
    for options in ({}, {"mode": "upsert"}):
        name = table("k FLOAT, v STRING")
        lm.load(spark.createDataFrame([(-0.0, "a"), (1.0, "b"), (1.0, "b")], "k double, v string"), name, keys=["k"], max_errors=10, **options)
        assert sorted(str(r.k) for r in spark.table(name).collect()) == ["-0.0", "1.0"]


def test_settings_of_the_session_do_not_change(spark, table):
    before = dict(spark.conf.getAll)
    name = table("k INTEGER, v STRING, p STRING", partition_by=["p"])
    batch = spark.createDataFrame([(i, "a", "x") for i in range(20)], P).coalesce(1)
    lm.load(batch, name, max_records_per_file=5)
    assert len(spark.table(name).inputFiles()) == 4
    lm.load(batch, name, mode="upsert", keys=["k", "p"], max_records_per_file=10)
    assert len(spark.table(name).inputFiles()) == 2
    assert dict(spark.conf.getAll) == before


def test_batch_size_bounds_the_rows_of_a_file(spark, table):
    for options in ({}, {"bucket_by": ["k"], "buckets": 1}):
        name = table(KV, **options)
        lm.store(spark.range(700).select(F.col("id").cast("int"), F.lit("x")).coalesce(1), name, batch_size=-1)
        files = spark.table(name).groupBy("_metadata.file_path").count().collect()
        assert sorted(r["count"] for r in files) == [100, 300, 300]


@pytest.mark.parametrize("mode,want", [("upsert", [(1, "a"), (2, "b"), (3, "z")]), ("append", [(1, "q"), (2, "c"), (3, "z")])])
def test_files_are_taken_in_their_order(spark, table, tmp_path, mode, want):
    (tmp_path / "f1").write_text("1\tq\n2\tc\n1\tx\n")
    (tmp_path / "f2").write_text("2\tb\n3\tz\n1\ta\n")
    name = table(KV)
    report = lm.load_file(spark, str(tmp_path), name, mode=mode, keys=["k"])
    assert rows(spark.table(name)) == want
    assert report.rejected == (0 if mode == "upsert" else 3)


def test_order_by_goes_before_the_order_of_a_file(spark, table, tmp_path):
    (tmp_path / "f").write_text("1\tb\n1\tc\n1\ta\n")
    name = table(KV)
    lm.load_file(spark, str(tmp_path), name, mode="upsert", keys=["k"], order_by=["v"])
    assert rows(spark.table(name)) == [(1, "c")]
