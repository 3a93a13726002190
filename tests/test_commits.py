"""What a load leaves behind: files, log entries and other loads' work."""

import glob
import json
import os
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.plans import load as load_module
from loadmason.plans.commits import CommitLog, Entry
from loadmason.plans.sinks import Layout, TableSink
from loadmason.session import new_path
from loadmason.streaming.micro_batch import batch_loader

KV = "k INTEGER, v STRING"
KVP = "k INTEGER, v STRING, p STRING"


def kv(spark, data):
    return spark.createDataFrame(data, "k int, v string")


def folder(spark, name):
    return TableSink(spark, name).location.replace("file:", "")


def files(spark, name):
    return set(glob.glob(f"{folder(spark, name)}/**/*.parquet", recursive=True))


def count_jobs(spark, action):
    group = f"jobs-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def spread(spark, name, parts=50):
    """A table of as many files, each with a hundred keys."""
    lm.load(spark.range(parts * 100, numPartitions=parts).select(F.col("id").cast("int"), F.lit("old")), name)


def test_an_upsert_writes_only_the_files_of_its_keys(spark, table):
    name = table(KV)
    spread(spark, name)
    before = files(spark, name)
    assert len(before) == 50
    lm.load(kv(spark, [(7, "new"), (9999, "new")]), name, mode="upsert", keys=["k"])
    after = files(spark, name)
    assert len(before - after) == 1 and 1 <= len(after - before) <= 3
    assert spark.table(name).count() == 5001
    assert rows(spark.table(name).where("v = 'new'")) == [(7, "new"), (9999, "new")]


def test_an_upsert_of_new_keys_only_adds_files(spark, table):
    name = table(KV)
    spread(spark, name, 4)
    before = files(spark, name)
    lm.load(kv(spark, [(-1, "new")]), name, mode="upsert", keys=["k"])
    assert before < files(spark, name) and spark.table(name).count() == 401


def test_foreign_files_stay(spark):
    place = new_path(spark, "odd name+")
    lm.create_table(spark, "foreign_files", KV, location=place)
    try:
        plain = place.replace("file:", "")
        lm.load(kv(spark, [(1, "0")]), "foreign_files")
        os.makedirs(f"{plain}/theirs")
        for path in (f"{plain}/theirs/notes.txt", f"{plain}/_notes"):
            with open(path, "w") as out:
                out.write("not ours")
        for number in range(4):
            lm.load(kv(spark, [(1, str(number))]), "foreign_files", mode="upsert", keys=["k"])
        assert rows(spark.table("foreign_files")) == [(1, "3")]
        assert sorted(f for f in os.listdir(plain) if not f.startswith(".")) == ["_notes", "theirs"]
        assert os.path.exists(f"{plain}/theirs/notes.txt")
    finally:
        spark.sql("DROP TABLE foreign_files")


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["p"]}, {"bucket_by": ["k"], "buckets": 3}])
@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_a_load_cut_short_behind_its_entry_is_completed(spark, table, monkeypatch, layout, mode):
    name = table(KVP, **layout)
    schema = "k int, v string, p string"
    lm.load(spark.createDataFrame([(k, "old", "abc"[k % 3]) for k in range(30)], schema), name)
    carry_out = TableSink._carry_out
    monkeypatch.setattr(TableSink, "_carry_out", lambda self, entry: 1 / 0)
    batch = spark.createDataFrame([(k, "new", "d") for k in range(100, 103)] + ([(0, "new", "d")] if mode == "upsert" else []), schema)
    with pytest.raises(ZeroDivisionError):
        lm.load(batch, name, mode=mode, keys=["k"])
    assert spark.table(name).where("v = 'new'").count() == 0
    monkeypatch.setattr(TableSink, "_carry_out", carry_out)
    lm.load(spark.createDataFrame([(200, "next", "e")], schema), name)
    want = [(k, "old", "abc"[k % 3]) for k in range(30) if k or mode == "append"]
    assert rows(spark.table(name)) == sorted([*want, *rows(batch), (200, "next", "e")], key=repr)


def test_a_load_cut_short_before_its_entry_never_was(spark, table, monkeypatch):
    name = table(KV)
    lm.load(kv(spark, [(1, "a")]), name)
    monkeypatch.setattr(CommitLog, "add", lambda self, number, entry: 1 / 0)
    for options in ({}, {"mode": "upsert", "keys": ["k"]}):
        with pytest.raises(ZeroDivisionError):
            lm.load(kv(spark, [(2, "b")]), name, **options)
    monkeypatch.undo()
    lm.load(kv(spark, [(3, "c")]), name)
    assert rows(spark.table(name)) == [(1, "a"), (3, "c")]
    assert not glob.glob(f"{folder(spark, name)}_commits/loading-*")


@pytest.mark.parametrize("first", [1, 40])
def test_neither_of_two_upserts_is_lost(spark, table, monkeypatch, first):
    """Another load commits between the reading of the table and the commit."""
    name = table(KV)
    spread(spark, name, first)
    write, done = TableSink._write, []

    def interrupted(self, frame, path):
        write(self, frame, path)
        if not done:
            done.append(True)
            lm.load(kv(spark, [(1, "theirs"), (2, "theirs")]), name, mode="upsert", keys=["k"])

    monkeypatch.setattr(TableSink, "_write", interrupted)
    lm.load(kv(spark, [(2, "ours"), (3, "ours")]), name, mode="upsert", keys=["k"])
    assert rows(spark.table(name).where("v <> 'old'")) == [(1, "theirs"), (2, "ours"), (3, "ours")]
    assert spark.table(name).count() == first * 100


def test_a_keyed_append_looks_again_at_a_changed_table(spark, table, monkeypatch):
    name, rejects = table(KV), new_path(spark, "rejects")
    publish, done = load_module._Batch.publish, []

    def interrupted(self, mode, version):
        if not done:
            done.append(True)
            lm.load(kv(spark, [(1, "theirs")]), name)
        publish(self, mode, version)

    monkeypatch.setattr(load_module._Batch, "publish", interrupted)
    report = lm.load(kv(spark, [(1, "ours"), (2, "ours")]), name, keys=["k"], reject_path=rejects)
    assert (report.loaded, report.rejected) == (1, 1)
    assert rows(spark.table(name)) == [(1, "theirs"), (2, "ours")]
    assert rows(spark.read.parquet(rejects).select("row_text")) == [("1|ours",)]


def test_upserts_at_the_same_time(spark, table):
    name = table(KV)
    spread(spark, name, 6)
    errors = []

    def upsert(number):
        try:
            lm.load(kv(spark, [(100 * number, f"by {number}"), (1, "both")]), name, mode="upsert", keys=["k"])
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=upsert, args=(n,)) for n in (2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert rows(spark.table(name).where("v <> 'old'")) == [(1, "both"), (200, "by 2"), (300, "by 3")]
    assert spark.table(name).count() == 600


def test_the_number_of_an_entry_is_taken_once(spark):
    log = CommitLog(spark, new_path(spark, "log"))
    assert log.latest() == (0, None)
    log.add(1, Entry("here", "append", batches={"ü": 3}))
    with pytest.raises(lm.CommitConflict):
        log.add(1, Entry("there", "append"))
    assert log.latest() == (1, Entry("here", "append", batches={"ü": 3}))
    assert all(not f.startswith("_") for f in os.listdir(log.folder.replace("file:", "")))


@pytest.mark.parametrize("layout", [{}, {"partition_by": ["p"]}])
@pytest.mark.parametrize("when", ["_carry_out", "_commit"])
def test_a_batch_that_comes_again_adds_nothing(spark, table, monkeypatch, layout, when):
    name, checkpoint = table(KVP, **layout), new_path(spark, "chk")
    batch = spark.createDataFrame([(1, "a", "x"), (1, "a", "x")], "k int, v string, p string")
    run, kept = batch_loader(spark, name, checkpoint), getattr(TableSink, when)

    def fails(self, *args, **options):
        if when == "_commit":
            kept(self, *args, **options)
        raise OSError("the driver is gone")

    monkeypatch.setattr(TableSink, when, fails)
    with pytest.raises(OSError):
        run(batch, 0)
    monkeypatch.setattr(TableSink, when, kept)
    for _ in range(2):
        run(batch, 0)
    assert spark.table(name).count() == 2
    run(batch, 1)
    assert spark.table(name).count() == 4
    batch_loader(spark, name, new_path(spark, "other"))(batch, 0)
    assert spark.table(name).count() == 6


def test_files_are_loaded_once(spark, table, tmp_path, monkeypatch):
    from loadmason.plans import sinks

    monkeypatch.setattr(sinks, "LEDGERS", 2)
    name = table(KV)
    for number in range(5):
        (tmp_path / f"f {number}%.tsv").write_text(f"{number}\ta\n")
        report = lm.load_file(spark, str(tmp_path), name, once=True)
        assert report.loaded == 1
    assert lm.load_file(spark, str(tmp_path), name, once=True).read == 0
    (tmp_path / "f 0%.tsv").write_text("10\tchanged\n")
    assert lm.load_file(spark, str(tmp_path), name, once=True).loaded == 1
    assert sorted(r.k for r in spark.table(name).collect()) == [0, 1, 2, 3, 4, 10]
    assert lm.load_file(spark, str(tmp_path), name).read == 5


def test_a_load_of_files_goes_on_where_it_was_cut_short(spark, table, tmp_path, monkeypatch):
    name = table(KV)
    (tmp_path / "a").write_text("1\ta\n2\tb\n")
    carry_out = TableSink._carry_out
    monkeypatch.setattr(TableSink, "_carry_out", lambda self, entry: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lm.load_file(spark, str(tmp_path), name, once=True)
    monkeypatch.setattr(TableSink, "_carry_out", carry_out)
    (tmp_path / "b").write_text("3\tc\n")
    assert lm.load_file(spark, str(tmp_path), name, once=True).loaded == 1
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_failed_load_lists_no_files(spark, table, tmp_path):
    name = table(KV)
    (tmp_path / "a").write_text("x\ta\n" * 20)
    with pytest.raises(lm.LoadAborted):
        lm.load_file(spark, str(tmp_path), name, once=True, on_error="reject")
    (tmp_path / "a").write_text("1\ta\n")
    assert lm.load_file(spark, str(tmp_path), name, once=True, on_error="reject").loaded == 1


def test_a_bad_load_ends_after_its_first_tasks(spark, table):
    """Every row is bad; one task after another would read two hundred parts."""
    name, rejects = table("a INTEGER"), new_path(spark, "rejects")
    source = new_path(spark, "bad")
    spark.range(200 * 3000, numPartitions=200).select(F.concat(F.lit("x"), "id").alias("a")).write.parquet(source)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    tracker, group = spark.sparkContext.statusTracker(), "bad-load"
    spark.sparkContext.setJobGroup(group, "")
    try:
        with pytest.raises(lm.LoadAborted) as caught:
            lm.load(spark.read.parquet(source), name, coerce="loose", on_error="reject", reject_path=rejects)
        done = sum(
            tracker.getStageInfo(s).numCompletedTasks + tracker.getStageInfo(s).numFailedTasks
            for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)
        )
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    report = caught.value.report
    assert not report.whole and report.rejected == 10 and done < 40
    assert spark.table(name).count() == 0
    kept = spark.read.parquet(rejects)
    assert kept.count() == 10 and kept.where("cause = 'a: string does not fit INTEGER'").count() == 10


def test_a_wave_that_reaches_the_limit_is_the_last(spark, table, tmp_path, monkeypatch):
    """Faults thinly spread over files: no task sees many."""
    monkeypatch.setattr(load_module, "FIRST_WAVE", 4)
    for number in range(30):
        (tmp_path / f"{number:02d}").write_text(f"{number}\ta\nx\tb\n")
    name = table(KV)
    with pytest.raises(lm.LoadAborted) as caught:
        lm.load_file(spark, str(tmp_path), name, on_error="reject", max_errors=6)
    report = caught.value.report
    assert (report.read, report.rejected, report.whole) == (40, 20, False)
    assert spark.read.parquet(report.reject_path).count() == 20 and spark.table(name).count() == 0
    report = lm.load_file(spark, str(tmp_path), name, on_error="reject", max_errors=31, keys=["k"])
    assert (report.read, report.loaded, report.rejected, report.whole) == (60, 30, 30, True)


def test_few_jobs(spark, table):
    """Half of what these loads took before they had a log, or less."""
    upserted = [table(KVP), table(KVP, bucket_by=["k"], buckets=4), table(KVP, partition_by=["p"])]
    data = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), (F.col("id") % 5).cast("string").alias("p"))
    batch = data.where("k % 10 = 0").unionByName(data.where("k % 20 = 0"))
    for name, most in zip(upserted, (21, 22, 32), strict=True):
        lm.load(data, name)
        assert count_jobs(spark, lambda: lm.load(batch, name, mode="upsert", keys=["k"])) <= most
    name = table(KVP)
    lm.load(data, name)
    report = []
    jobs = count_jobs(spark, lambda: report.append(lm.load(batch, name, keys=["k"], max_errors=10**6)))
    assert report[0].loaded == 0 and report[0].rejected == 150 and jobs <= 16


def test_partitions_with_a_place_of_their_own(spark, table):
    name, elsewhere = table(KVP, partition_by=["p"]), new_path(spark, "elsewhere")
    schema = "k int, v string, p string"
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (p = 'x') LOCATION '{elsewhere}'")
    lm.load(spark.createDataFrame([(k, "a", "x") for k in range(20)] + [(50, "a", "y")], schema).coalesce(1), name, max_records_per_file=10)
    assert len(glob.glob(f"{elsewhere.replace('file:', '')}/*.parquet")) == 2
    lm.load(spark.createDataFrame([(1, "b", "x"), (50, "b", "z")], schema), name, mode="upsert", keys=["k"])
    assert spark.table(name).where("p = 'x'").count() == 20 and rows(spark.table(name).where("v = 'b'")) == [(1, "b", "x"), (50, "b", "z")]
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=x", "p=z"]


def test_a_table_made_anew_starts_a_new_log(spark):
    place = new_path(spark, "again")
    for _ in range(2):
        lm.create_table(spark, "made_again", KV, location=place)
        batch_loader(spark, "made_again", "/chk/again")(kv(spark, [(1, "a")]), 0)
        assert spark.table("made_again").count() == 1
        spark.sql("DROP TABLE made_again")
        for file in glob.glob(f"{place.replace('file:', '')}/*"):
            os.remove(file)
        for file in glob.glob(f"{place.replace('file:', '')}/.*"):
            os.remove(file)
    assert json.loads(open(glob.glob(f"{place.replace('file:', '')}_commits/*1.json")[0]).read())["kind"] == "append"


def test_formats_that_cannot_be_written_by_path(spark):
    place = new_path(spark, "csv")
    spark.sql(f"CREATE TABLE with_options (k INT, v STRING) USING csv OPTIONS (sep '|') LOCATION '{place}'")
    try:
        assert not Layout.of(spark, "with_options").owned
        lm.load(kv(spark, [(1, "a")]), "with_options")
        assert rows(spark.table("with_options")) == [(1, "a")]
        with pytest.raises(ValueError):
            lm.load(kv(spark, [(1, "a")]), "with_options", mode="upsert", keys=["k"])
    finally:
        spark.sql("DROP TABLE with_options")
