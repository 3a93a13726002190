"""The load path, run for each micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.schema import check, check_target
from ..plans.load import load
from ..plans.sinks import MERGING_FORMATS, TableSink
from ..session import is_marked, mark

DEFAULT_INTERVAL = "10 seconds"


def once_per_batch(
    spark: SparkSession, table: str, checkpoint: str, work: Callable[[DataFrame, TableSink], None], stateful: bool = False
) -> Callable[[DataFrame, int], None]:
    """Does the work for a batch unless one of its number has been loaded.

    The sink notes the number in the commit that adds the rows, so there is no
    moment between the two. Tables without a commit log get a mark afterwards.
    A ``stateful`` batch is computed again even so, as its state may be missing.
    """
    stream = checkpoint.rstrip("/")

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        done = f"{stream}_loaded/{batch_id}"
        sink = TableSink(batch.sparkSession, table)
        if sink.layout.owned:
            if sink.loaded_batch(stream) < batch_id:
                sink.batch = (stream, batch_id)
                work(batch, sink)
            elif stateful:
                batch.write.format("noop").mode("overwrite").save()
        elif not is_marked(spark, done):
            work(batch, sink)
            mark(spark, done)
        # batches run in a session of their own; let the caller's see the new files
        spark.catalog.refreshTable(table)

    return load_batch


def batch_loader(spark: SparkSession, table: str, checkpoint: str, **options) -> Callable[[DataFrame, int], None]:
    """Loads a batch by :func:`load` unless one of its number has been loaded."""
    return once_per_batch(spark, table, checkpoint, lambda batch, sink: load(batch, table, batch=sink.batch, **options))


def load_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = DEFAULT_INTERVAL,
    rewrite_whole: bool = False,
    **options,
) -> StreamingQuery:
    """Starts loading a stream into a table; takes the options of :func:`load`.

    ``every`` is the trigger interval; None loads what there is and stops. The
    schema is checked before the stream starts. A batch is committed together
    with its number, and one that runs again adds nothing, wherever the driver
    was lost. The stream goes by its checkpoint's name there.

    An upsert into a table without partitions is refused unless
    ``rewrite_whole`` says that it is wanted: batches whose keys lie in most
    of its files would write all of it anew, each time.
    """
    spark = stream.sparkSession
    check(stream.schema, check_target(spark, table), options.get("coerce", "strict"))
    layout = TableSink(spark, table).layout
    if options.get("mode") == "upsert" and not rewrite_whole and layout.provider not in MERGING_FORMATS and not layout.partitions:
        raise ValueError(f"every batch would write all of {table} anew: partition it, use a format with MERGE, or set rewrite_whole")
    load_batch = batch_loader(spark, table, checkpoint, **options)
    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
