"""The shape of the plans, which is what carries over to a large cluster."""

import pytest
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.operators.checked import convert_frame
from loadmason.operators.keys import one_per_key

LINE = "/root/testdata/sf0.001/lineitem.parquet"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lineitem(spark):
    return spark.read.parquet(LINE)


def typed(spark):
    return lineitem(spark).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))


def test_conversion_does_not_shuffle_or_leave_the_jvm(spark):
    target = "a STRING, b VARBINARY, c DECIMAL, d STRING, e VARBINARY, f DECIMAL, g TIMESTAMP, h STRING, i VARBINARY, j STRING, k VARBINARY"
    for frame in (convert_frame(lineitem(spark), target).flagged(), convert_frame(lineitem(spark), target).failing()):
        text = plan(frame)
        assert "Exchange" not in text and "BatchEvalPython" not in text
        # one cell here has no expression in the JVM; it takes whole Arrow batches
        assert text.count("ArrowEvalPython") == 1 and "_ieee_bytes" in text
    without = target.replace("e VARBINARY", "e STRING")
    assert "Python" not in plan(convert_frame(lineitem(spark), without).flagged())


def test_filters_pass_a_cell_that_runs_in_arrow(spark):
    df = lm.coerce(lineitem(spark).select("l_orderkey", "l_quantity"), "a BIGINT, b VARBINARY").filter("a < 10")
    assert "_ieee_bytes" in plan(df) and "LessThan(l_orderkey,10)" in plan(df)


def test_filters_pass_the_flagged_frame(spark):
    df = lm.coerce(lineitem(spark).select("l_orderkey", "l_tax"), "a BIGINT, b INTEGER", mode="loose", on_error="flag")
    assert "LessThan(l_orderkey,10)" in plan(df.filter("a < 10"))


def test_only_exact_decimals_use_python(spark):
    df = lineitem(spark).select("l_tax")
    assert "ArrowEvalPython" in plan(lm.coerce(df, "a DECIMAL", exact_decimals=True))
    assert "ArrowEvalPython" not in plan(lm.coerce(df, "a DECIMAL"))


def test_scan_and_render_are_one_stage(spark):
    df = typed(spark)
    text = plan(lm.parse_lines(lm.render(df), df.schema))
    assert "Exchange" not in text and "Python" not in text


def test_only_wanted_columns_are_read(spark):
    wanted = lm.coerce(typed(spark), typed(spark).schema).select("l_orderkey", "l_tax")
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan(wanted)


def test_filters_reach_the_scan(spark):
    df = lm.coerce(typed(spark), typed(spark).schema).filter("l_orderkey < 10")
    assert "LessThan(l_orderkey,10)" in plan(df)


def test_accepted_rows_are_worked_out_once(spark):
    """The fault filter stays above the conversion instead of repeating it below."""
    accepted = lm.coerce(lineitem(spark).select("l_orderkey"), "a TINYINT", mode="loose", on_error="reject").accepted
    assert plan(accepted).count("try_cast") == 1


def test_one_row_per_key_is_combined_before_its_shuffle(spark):
    text = plan(one_per_key(lineitem(spark), ["l_orderkey"], ["l_shipdate"]))
    assert "Window" not in text and text.count("Exchange") == 1
    assert "partial_min" in text and text.index("partial_min") > text.index("Exchange")


def test_row_diff_shuffles_once(spark):
    text = plan(lm.row_diff(lineitem(spark), lineitem(spark).filter("l_orderkey > 5")))
    assert text.count("Exchange") == 1 and "partial_sum" in text


@pytest.mark.parametrize("small", [True, False])
def test_anti_join_broadcasts_only_when_told(spark, small):
    from loadmason.operators.keys import without_keys

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(without_keys(lineitem(spark), lineitem(spark).select("l_orderkey").distinct(), ["l_orderkey"], small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in text) == small


def test_a_bucketed_target_is_not_shuffled_by_an_upsert(spark, table):
    from loadmason.operators.keys import without_keys

    name = table(typed(spark).schema, bucket_by=["l_orderkey"], buckets=4)
    lm.load(typed(spark), name)
    latest = one_per_key(typed(spark), ["l_orderkey"]).drop("__copies")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = without_keys(spark.table(name), latest, ["l_orderkey"], small=False, null_safe=False)
        text = plan(kept)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_side = text[: text.index("l_orderkey#", text.index("FileScan"))]
    assert "Exchange" not in target_side and "Bucketed: true" in text


def test_only_partitioned_and_bucketed_targets_gather_rows(spark, table):
    from loadmason.plans.sinks import TableSink

    rows = spark.sql("select 1 a, 2 b")
    for options, shuffled in (({}, False), ({"partition_by": ["b"]}, True), ({"bucket_by": ["a"], "buckets": 3}, True)):
        sink = TableSink(spark, table("a INTEGER, b INTEGER", **options))
        assert ("REBALANCE" in plan(sink._gathered(rows))) == shuffled


@pytest.mark.parametrize("keys", [["l_orderkey", "l_returnflag"], ["l_orderkey"]])
def test_an_upsert_by_partition_scans_touched_partitions_only(spark, table, keys, monkeypatch):
    from loadmason.plans.sinks import TableSink

    last = [c for c in lineitem(spark).columns if c != "l_returnflag"] + ["l_returnflag"]
    rows = typed(spark).select(*last)
    name = table(rows.schema, partition_by=["l_returnflag"])
    lm.load(rows, name)
    seen = []
    found = TableSink._of_partitions
    monkeypatch.setattr(TableSink, "_of_partitions", lambda *args: seen.append(found(*args)) or seen[-1])
    lm.load(rows.filter("l_returnflag = 'A'"), name, mode="upsert", keys=keys)
    if "l_returnflag" in keys:
        assert "dynamicpruning" in plan(seen[0]) and "BroadcastHashJoin" in plan(seen[0])
    assert spark.table(name).count() < rows.count() + 1


def test_cold_keys_are_joined_without_the_rows_of_hot_ones(spark):
    from loadmason.operators.keys import COPIES, join_counted

    rows = lineitem(spark).select("l_orderkey", "l_tax")
    per_key = rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias(COPIES))
    joined = join_counted(rows, per_key, ["l_orderkey"], rows.count(), 100, 10**6, null_safe=False)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftAnti") == 1 and text.count("rightHint=(strategy=broadcast)") == 2
    assert joined.count() == rows.count()


def test_null_keys_are_not_shuffled(spark):
    from loadmason.operators.keys import without_keys

    rows = lineitem(spark).select(F.when(F.col("l_orderkey") > 9, F.col("l_orderkey")).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = without_keys(rows, rows.where("k = 10").distinct(), ["k"], False, null_safe=False)
        assert "Union" in plan(kept) and "isnull" in plan(kept)
        assert kept.count() == rows.where("k IS NULL OR k <> 10").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unique_keys_are_not_sorted(spark, table, monkeypatch):
    from loadmason.plans import load as module

    name, used = table("a BIGINT, b FLOAT"), []
    monkeypatch.setattr(module, "one_per_key", lambda *args, **options: used.append(args))
    batch = lineitem(spark).select("l_orderkey", "l_tax").dropDuplicates(["l_orderkey"])
    lm.load(batch, name, mode="upsert", keys=["a"])
    assert not used and spark.table(name).count() == batch.count()
