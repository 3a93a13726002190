"""Rows dealt to tasks in whole batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TASK = "__task"
NTH = "__nth"
START = "__start"
BATCH = "__batch"


def whole_batches(rows: DataFrame, size: int) -> DataFrame:
    """The same rows, of which each task holds whole batches of ``size``; the last batch alone may have fewer.

    Rows are numbered through from the number each task holds, which is counted
    first, and shuffled by the number of their batch. A frame whose tasks hold
    other rows when it is read again keeps all rows, but not the sizes.
    """
    if size < 1:
        raise ValueError("a batch has at least one row")
    counts = sorted(rows.groupBy(F.spark_partition_id().alias(TASK)).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for task, n in counts:
        starts.append((task, total))
        total += n
    listed = F.broadcast(rows.sparkSession.createDataFrame(starts, f"{TASK} int, {START} long"))
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.withColumns({TASK: F.spark_partition_id(), NTH: nth}).join(listed, TASK, "left")
    batch = F.floor((F.coalesce(F.col(START), F.lit(0)) + F.col(NTH)) / F.lit(size))
    return numbered.withColumn(BATCH, batch).repartition(BATCH).select(*rows.columns)
