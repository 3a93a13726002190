"""Appends of a stream by key: the first row of each key is loaded, told by Spark's state store.

The target is not read for each batch. Its files are a second stream, of which
only the keys are taken: those that are there when the stream starts with the
first batch, and later ones, whoever added them, with the batch after. Every key
that came up is one entry of the state store, which says of a batch's keys which
are new. What the rows of a key become is then told by sorting them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.coerce import Cell
from ..functions.parsing import pattern_or_default
from ..functions.types import Target, TargetColumn
from ..operators.checked import FAULT, REJECT_SEPARATOR, ROW_TEXT, Checked, Field, convert_frame, row_text
from ..operators.keys import compared_columns
from ..plans.load import LOAD_ON_ERROR, PRESENT, REPEATED, run_load
from ..plans.sinks import TableSink
from ..session import make_folder
from .micro_batch import DEFAULT_INTERVAL, once_per_batch

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HELD = "__held"
NEW = "__new"
LANE = "__lane"
LANES = 256


def load_keyed_stream(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    every: str | None = DEFAULT_INTERVAL,
    order_by: Sequence[str] = (),
    coerce: str = "strict",
    on_error: str = "fail",
    max_errors: int | None = None,
    date_format: str | None = None,
    exact_decimals: bool = False,
    reject_path: str | None = None,
    max_records_per_file: int | None = None,
) -> StreamingQuery:
    """Starts appending the first row of each key, over all batches and what the table holds.

    Of rows of one batch the first is by ``order_by``, then by the other
    columns, as in :func:`load`. All other rows are rejected and count against
    the limit of their batch, with the causes of :func:`load`: the key was in
    the table or in an earlier batch, or it is repeated in this one.

    Null keys are equal to each other. Rows that do not convert take no key,
    and each goes its own way past the state. Rows of a key are sorted in one
    task, which spills them. Batches are committed with their number.

    The table must be one whose files are below its location, and which other
    loads only append to while the stream runs.
    """
    spark = stream.sparkSession
    sink = TableSink(spark, table, max_records_per_file)
    target, layout = sink.target, sink.layout
    if not layout.owned:
        raise ValueError(f"{table}: files of {layout.provider or 'this format'} cannot be followed")
    if on_error not in LOAD_ON_ERROR:
        raise ValueError(f"on_error must be one of {LOAD_ON_ERROR}, not {on_error!r}")
    unknown = [c for c in [*keys, *order_by] if c not in target.names]
    if unknown or not keys:
        raise ValueError(f"the target has no columns {unknown}" if unknown else "a keyed stream needs key columns")
    make_folder(spark, sink.location)

    checked = convert_frame(stream, target, coerce, date_format, exact_decimals)
    rows = checked.flagged() if on_error == "reject" else checked.failing()
    if on_error != "reject":
        rows = rows.withColumns({FAULT: F.lit(None).cast("string"), ROW_TEXT: F.lit(None).cast("string")})
    groups = [f"g{i}" for i in range(len(keys))]
    there = spark.readStream.format(layout.provider).schema(_schema(target)).option("ignoreMissingFiles", True).load(sink.location)
    held = there.select(*_groups(target, keys), F.lit(True).alias(HELD))
    fault = F.col(FAULT).isNotNull()
    keyed = rows.select(*[F.col(c.name).alias(f"v{i}") for i, c in enumerate(target.columns)], *_groups(target, keys), FAULT, ROW_TEXT)
    # rows that do not convert have no key; they are spread over a few lanes of their own
    lane = F.when(fault, F.pmod(F.xxhash64(ROW_TEXT), F.lit(LANES)))
    arriving = keyed.withColumns({**{g: F.when(~fault, F.col(g)) for g in groups}, LANE: lane, HELD: F.lit(False)})
    # shuffled once, and taken from there twice: as it is, and one of each key that is new to the state store
    both = arriving.unionByName(held, allowMissingColumns=True).repartition(*groups, LANE)
    batches = both.withColumn(NEW, F.lit(False)).unionByName(both.dropDuplicates([*groups, LANE]).withColumn(NEW, F.lit(True)))

    pattern = pattern_or_default(date_format)

    def load_batch(batch: DataFrame, into: TableSink) -> None:
        into.max_records_per_file = max_records_per_file
        # every part is read, so that the state of this batch is whole
        run_load(batch.sparkSession, _judged(batch, target, keys, order_by, pattern), into, "append", (), (), "reject", max_errors, reject_path, date_format, False)

    once = once_per_batch(spark, table, checkpoint, load_batch, stateful=True)
    writer = batches.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    before = spark.conf.get(STATE_STORE)
    # a stream takes its settings when it starts; the session keeps its own
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, before)


def _schema(target: Target) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type) for c in target.columns])


def _as_bytes(value: Column, column: TargetColumn) -> Column:
    """A value in a form that pandas does not change."""
    if column.type == "VARBINARY":
        return value
    if column.type == "TIMESTAMP":
        value = F.unix_micros(value)
    return value.cast("string").cast("binary")


def _groups(target: Target, keys: Sequence[str]) -> list[Column]:
    """Keys as bytes that are equal where Spark calls the keys equal."""
    by_name = {c.name: c for c in target.columns}
    zero_signed = [F.col(k) + F.lit(0.0) if by_name[k].type == "FLOAT" else F.col(k) for k in keys]
    return [_as_bytes(value, by_name[k]).alias(f"g{i}") for i, (k, value) in enumerate(zip(keys, zero_signed, strict=True))]


def _judged(batch: DataFrame, target: Target, keys: Sequence[str], order_by: Sequence[str], pattern: str) -> Checked:
    """The rows of a batch; the cause of a reject stands for the row as a whole."""
    values = {c.name: f"v{i}" for i, c in enumerate(target.columns)}
    of_key = Window.partitionBy(*[f"g{i}" for i in range(len(keys))], LANE)
    mark = F.col(HELD) | F.col(NEW)
    in_order = of_key.orderBy(mark.desc(), *[values[c] for c in compared_columns(target.names, keys, order_by)])
    # what is known of the key is sorted before its rows, of which the first has no row before it
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    layer = batch.withColumns({
        "held": F.max(F.col(HELD) & ~F.col(NEW)).over(so_far),
        "new": F.max(NEW).over(so_far),
        "nth": F.sum(F.when(mark, 0).otherwise(1)).over(so_far),
    }).where(~mark)
    known = F.col("held") | ~F.col("new")
    cause = F.when(F.col(FAULT).isNotNull(), F.col(FAULT)).when(known, F.lit(PRESENT)).when(F.col("nth") > 1, F.lit(REPEATED))
    shown = row_text([(F.col(f"v{i}"), c) for i, c in enumerate(target.columns)], REJECT_SEPARATOR, pattern)
    layer = layer.select(*values.values(), cause.alias("cause"), F.coalesce(ROW_TEXT, shown).alias("shown"))
    fields = [Field(c, f"v{i}", Cell(F.col(f"v{i}"), None), c.name) for i, c in enumerate(target.columns)]
    return Checked(layer, fields, "cause", F.col("shown"))
