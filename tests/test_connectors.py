import pytest
from conftest import rows
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.plans import job
from loadmason.session import CHECKPOINT_DIR, new_path, shared_dir
from loadmason.streaming.micro_batch import batch_loader


def test_job_loads(spark, table, tmp_path, capsys):
    (tmp_path / "in").write_text("1|x\n2|b\n1|c\n")
    name = table("k INTEGER, v STRING")
    assert job.main([str(tmp_path / "in"), name, "--sep", "|", "--upsert", "--keys", "k, ,"]) == 0
    assert "read 3, loaded 3, rejected 0" in capsys.readouterr().out
    assert rows(spark.table(name)) == [(1, "c"), (2, "b")]


def test_job_fails_with_a_code(spark, table, tmp_path, capsys):
    (tmp_path / "in").write_text("1\ta\nx\tb\n")
    name = table("k INTEGER, v STRING")
    assert job.main([str(tmp_path / "in"), name]) == 1
    assert job.main([str(tmp_path / "in"), "no_such_table"]) == 1
    assert job.main([str(tmp_path / "in"), name, "--on-error", "reject", "--max-errors", "1"]) == 1
    assert "maximum of allowable errors" in capsys.readouterr().err
    assert spark.table(name).count() == 0


@pytest.mark.parametrize("argv", [[], ["file"], ["file", "table", "--nope"], ["file", "table", "--sep"], ["f", "t", "--on-error", "x"]])
def test_job_refuses_bad_options(argv):
    with pytest.raises(SystemExit) as stopped:
        job.parse(argv)
    assert stopped.value.code != 0


def test_job_lists():
    assert job.names("k1") == ["k1"]
    assert job.names(" , ,") == []
    assert job.names("region , k1,") == ["region", "k1"]


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_loads_every_batch(spark, table, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(90).select(F.col("id").cast("int").alias("k"), F.col("id").cast("string").alias("v")).repartition(3).write.parquet(folder)
    name = table("k INTEGER, v STRING")
    checkpoint = new_path(spark, "checkpoint")
    for _ in range(2):  # a restart with nothing new adds nothing
        query = lm.load_stream(stream_of(spark, folder, "k int, v string"), name, checkpoint, every=None)
        query.awaitTermination()
    assert spark.table(name).count() == 90


def test_stream_upserts(spark, table, tmp_path):
    folder, schema = str(tmp_path / "in"), "v string, k int"
    spark.createDataFrame([("a", 1), ("a", 2)], schema).coalesce(1).write.parquet(folder)
    name, checkpoint = table("v STRING, k INTEGER", partition_by=["k"]), new_path(spark, "checkpoint")
    for more in ([("b", 2), ("b", 3)], None):
        stream = stream_of(spark, folder, schema)
        lm.load_stream(stream, name, checkpoint, every=None, mode="upsert", keys=["k"]).awaitTermination()
        if more:
            spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(folder)
    assert rows(spark.table(name)) == [("a", 1), ("b", 2), ("b", 3)]


def test_stream_upserts_do_not_rewrite_a_whole_table_unasked(spark, table, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(folder)
    name, options = table("k INTEGER, v STRING"), {"every": None, "mode": "upsert", "keys": ["k"]}
    with pytest.raises(ValueError, match="anew"):
        lm.load_stream(stream_of(spark, folder, "k int, v string"), name, new_path(spark, "c"), **options)
    stream = stream_of(spark, folder, "k int, v string")
    lm.load_stream(stream, name, new_path(spark, "c"), rewrite_whole=True, **options).awaitTermination()
    assert rows(spark.table(name)) == [(1, "a")]


def test_a_batch_that_runs_again_adds_nothing(spark, table):
    name, checkpoint = table("k INTEGER, v STRING"), new_path(spark, "checkpoint")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for number in (0, 0, 1, 0):
        batch_loader(spark, name, checkpoint)(batch, number)
    assert spark.table(name).count() == 4


def test_stream_interval(spark, table, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(folder)
    name = table("k INTEGER, v STRING")
    query = lm.load_stream(stream_of(spark, folder, "k int, v string"), name, new_path(spark, "checkpoint"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table(name)) == [(1, "a")]


def test_stream_schema_is_checked_before_it_starts(spark, table, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(folder)
    with pytest.raises(lm.SchemaMismatch):
        lm.load_stream(stream_of(spark, folder, "k int, v string"), table("k STRING, v INTEGER"), new_path(spark, "c"))


def test_work_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_DIR).rstrip("/")
    assert new_path(spark, "x").startswith(shared_dir(spark))


class Unset:
    """A session without the setting."""

    def __init__(self, master):
        self.settings, self.conf = {"spark.master": master}, self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match=CHECKPOINT_DIR):
            shared_dir(Unset(master))
    local = Unset("local[4]")
    assert shared_dir(local) == shared_dir(local)
