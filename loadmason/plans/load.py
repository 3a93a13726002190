"""Loading checked rows into a target, with rejects set aside and a fault limit.

Nothing reaches the target before every fault is known. Where rows cannot
fault and have no keys they are written straight through. Otherwise they are
staged once as Parquet in the shared folder, with their faults; the counts, the
choice of one row per key and the rejects are then read from the stage, so the
source is evaluated once and a lost executor changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import CommitConflict, LoadAborted
from ..functions.parsing import pattern_or_default
from ..functions.types import DEFAULT_SEPARATOR, Target
from ..operators.checked import ARRIVAL, FAULT, REJECT_SEPARATOR, ROW, ROW_TEXT, Checked, convert_frame, row_text
from ..operators.faults import effective_limit
from ..operators.keys import (
    BROADCAST_BYTES,
    COPIES,
    any_null,
    compared_columns,
    key_bytes,
    left_with_key_row,
    one_per_key,
    repeated_keys,
    with_keys,
    without_keys,
)
from ..session import drop_path, new_path
from ..sources.delimited import check_lines, listed_files, new_files, read_lines
from .commits import retried
from .sinks import KEEP_VERSIONS, JdbcSink, TableSink, effective_batch_size

REPEATED = "repeated key"
PRESENT = "key already in target"
HIT = "__hit"
CAUSE = "__cause"
CHOSEN = "__chosen"
# Staged rows and rejects are written more often than they are read, so they are packed tighter than tables.
SMALL_FILES = ("compression", "zstd")
# A task that alone finds this many faults more than the limit ends the load. As many are kept of them at most.
EARLY_FAULTS = 1000
# From this share of rows with repeated keys on, one aggregation of all rows costs less than setting those apart.
REPEATED_SHARE = 0.5
# The same where the rows are many, by an estimate of this error made as they are staged.
SURPLUS_SHARE = 0.1
DISTINCT_ERROR = 0.02
# Files of the first wave of a load from files, at least; each wave is four times the one before.
FIRST_WAVE = 32
WAVE_GROWTH = 4
LOAD_ON_ERROR = ("fail", "reject")


@dataclass(frozen=True)
class LoadReport:
    table: str
    read: int
    loaded: int
    rejected: int
    max_errors: int
    reject_path: str | None = None
    whole: bool = True  # False where the limit was reached before everything was read; the counts are of what was


def load(
    df: DataFrame,
    table: str,
    mode: str = "append",
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    coerce: str = "strict",
    on_error: str = "fail",
    max_errors: int | None = None,
    date_format: str | None = None,
    exact_decimals: bool = False,
    reject_path: str | None = None,
    max_records_per_file: int | None = None,
    batch_size: int | str | None = None,
    keep_versions: int = KEEP_VERSIONS,
    batch: tuple[str, int] | None = None,
    stop_early: bool = True,
) -> LoadReport:
    """Loads a frame into a catalog table, matching columns by position.

    ``append`` with ``keys`` rejects rows whose key is in the target already
    and all but the first of a repeated key; ``upsert`` keeps the last of a
    repeated key and replaces the target's row. First and last are by
    ``order_by``, then by the other columns: a frame's rows have no order.

    ``batch_size``, where given, bounds the rows of a file, and values that are
    not above zero mean the default of 300; ``max_records_per_file`` is the
    same without a default.

    Where rows may be rejected, a task that alone finds clearly more faults
    than the limit ends the load at once, with its first rejects kept. Without
    ``stop_early`` all rows are read and all rejects kept before it ends.

    ``batch`` names a stream and the number of its batch, which the commit
    notes together with the rows; :func:`load_stream` uses it.
    """
    if batch_size is not None:
        max_records_per_file = effective_batch_size(batch_size)
    sink = TableSink(df.sparkSession, table, max_records_per_file, keep_versions)
    sink.batch = batch
    checked = convert_frame(df, sink.target, coerce, date_format, exact_decimals)
    return run_load(df.sparkSession, checked, sink, mode, keys, order_by, on_error, max_errors, reject_path, date_format, stop_early)


def store(df: DataFrame, table: str, **options) -> LoadReport:
    """Loads any frame whose columns go into the target's strictly."""
    return load(df, table, coerce="strict", **options)


def insert_exact(df: DataFrame, table: str, **options) -> LoadReport:
    """Loads a frame whose types are the target's own; only timestamps change, to milliseconds."""
    return load(df, table, coerce="exact", **options)


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    coerce: str = "strict",
    on_error: str = "fail",
    max_errors: int | None = None,
    batch_size: int | None = None,
    date_format: str | None = None,
    reject_path: str | None = None,
    **options: str,
) -> LoadReport:
    """Appends a frame to a table behind JDBC, ``batch_size`` rows per insert.

    Other options are Spark's. With ``keys`` the table's keys are read, over one
    connection unless the options ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` split that read.
    """
    sink = JdbcSink(df.sparkSession, url, table, batch_size, **options)
    checked = convert_frame(df, sink.target, coerce, date_format)
    return run_load(df.sparkSession, checked, sink, "append", keys, order_by, on_error, max_errors, reject_path, date_format)


def load_file(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    mode: str = "append",
    keys: Sequence[str] = (),
    order_by: Sequence[str] = (),
    sep: str | None = DEFAULT_SEPARATOR,
    date_format: str | None = None,
    on_error: str = "fail",
    max_errors: int | None = None,
    reject_path: str | None = None,
    max_records_per_file: int | None = None,
    recursive: bool = False,
    keep_versions: int = KEEP_VERSIONS,
    once: bool = False,
    stop_early: bool = True,
) -> LoadReport:
    """Loads delimited text into a catalog table.

    Of lines with the same key and ``order_by`` the first (or with upsert the
    last) in the file counts; files are taken in the order of their names.

    Where lines may be rejected the files are read in growing waves, and a
    wave that reaches the fault limit is the last, unless ``stop_early`` is
    False; see :func:`load`. With ``once`` files are left
    out that this table's commit log lists with the same path, size and time:
    a load that is repeated adds nothing, one that was cut short goes on.
    """
    sink = TableSink(spark, table, max_records_per_file, keep_versions)
    stage = new_path(spark, "files")
    if once:
        if not sink.layout.owned:
            raise ValueError(f"{table}: this format has no commit log to list files in")
        listed = new_files(spark, listed_files(spark, paths, recursive), sink.ledgers())
        listed.write.parquet(stage)
        sink.ledger = spark.read.schema(listed.schema).parquet(stage)
        # names of files only, which Spark holds for a scan as well
        names = [r.path for r in sink.ledger.select("path").collect()]
    else:
        # few files are one wave, whatever they are called
        many = on_error == "reject" and stop_early and len(read_lines(spark, paths, recursive).inputFiles()) > first_wave(spark)
        names = [r.path for r in listed_files(spark, paths, recursive).select("path").collect()] if many else []
    try:
        if once and not names:
            return LoadReport(table, 0, 0, 0, effective_limit(max_errors))
        parts = waves(spark, names) if on_error == "reject" and stop_early else [names]
        if not once and len(parts) < 2:
            parts = [None]
        lines = [read_lines(spark, paths, recursive, bool(keys), part) for part in parts]
        checked = [check_lines(part, sink.target, sep, date_format) for part in lines]
        return run_load(spark, checked, sink, mode, keys, order_by, on_error, max_errors, reject_path, date_format, stop_early)
    finally:
        if once:
            drop_path(spark, stage)


def first_wave(spark: SparkSession) -> int:
    return max(FIRST_WAVE, spark.sparkContext.defaultParallelism)


def waves(spark: SparkSession, names: Sequence[str]) -> list[list[str]]:
    """The files in growing groups, each at least as many as can be read at a time."""
    names, out, size = sorted(names), [], first_wave(spark)
    while names:
        out.append(names[:size])
        names, size = names[size:], size * WAVE_GROWTH
    return out


def run_load(
    spark: SparkSession,
    checked: Checked | Sequence[Checked],
    sink,
    mode: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    on_error: str,
    max_errors: int | None,
    reject_path: str | None,
    date_format: str | None = None,
    stop_early: bool = True,
) -> LoadReport:
    """Loads checked rows; several of them are waves of one load, staged one after another."""
    waves = [checked] if isinstance(checked, Checked) else list(checked)
    first = waves[0]
    limit = effective_limit(max_errors)
    if mode not in ("append", "upsert"):
        raise ValueError(f"mode must be append or upsert, not {mode!r}")
    if on_error not in LOAD_ON_ERROR:
        raise ValueError(f"on_error must be one of {LOAD_ON_ERROR}, not {on_error!r}")
    if mode == "upsert" and not keys:
        raise ValueError("upsert needs key columns")
    unknown = [c for c in [*keys, *order_by] if c not in first.names]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    rejecting = on_error == "reject" and first.can_fault
    if not keys and not rejecting and len(waves) == 1:
        return _straight(first, sink, limit)

    stage = new_path(spark, "load")
    try:
        batch = _Batch(spark, stage, sink, list(keys), list(order_by), pattern_or_default(date_format))
        batch.stage_rows(waves, rejecting, bool(keys) and (mode == "append" or first.arrives), limit, reject_path, stop_early)
        return retried(lambda: batch.finish(mode, limit, reject_path))
    finally:
        drop_path(spark, stage)


def _straight(checked: Checked, sink, limit: int) -> LoadReport:
    seen = Observation("load")
    sink.append(checked.failing(), seen)
    count = seen.get["rows"]
    return LoadReport(sink.name, count, count, 0, limit)


def stopping(limit: int, token: str) -> Column:
    """The fault, unless this task alone has seen clearly more than the limit: then the job ends.

    The number counts only the rows it is asked for, which are the faulty ones.
    """
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fault = F.col(FAULT)
    return F.when(fault.isNull(), fault).when(nth >= limit + EARLY_FAULTS, F.raise_error(F.lit(token)).cast("string")).otherwise(fault)


class _Batch:
    """The staged rows of one load and what has been found out about them."""

    def __init__(self, spark, stage: str, sink, keys: list[str], order_by: list[str], date_format: str):
        self.spark, self.stage, self.sink = spark, stage, sink
        self.keys, self.order_by, self.date_format = keys, order_by, date_format
        self.rows: DataFrame | None = None  # accepted so far
        self.faulty: DataFrame | None = None
        self.picked: DataFrame | None = None  # one row per key
        self.judged: DataFrame | None = None  # all of them, with why the key refuses one
        self.read = self.faults = self.n_keys = self.by_key = 0
        self.surplus = 0  # about how many rows there are beyond one a key
        self.broadcast_keys, self.null_safe, self.arrives = 1, True, False

    def stage_rows(self, waves: list[Checked], rejecting: bool, numbered: bool, limit: int, reject_path: str | None, stop_early: bool) -> None:
        """Writes the rows out, counting in the same pass; stops after the wave that reaches the limit."""
        self.arrives = waves[0].arrives
        token, paths, widest, null_keys, schema = uuid.uuid4().hex, [], 0, 0, None
        for number, checked in enumerate(waves):
            rows = checked.flagged(numbered) if rejecting else checked.failing(numbered)
            if rejecting and stop_early:
                rows = rows.withColumn(FAULT, stopping(limit, token))
            if numbered:
                # written out, the numbers are fixed; they tell equal rows apart
                row = F.col(ARRIVAL) if self.arrives else F.monotonically_increasing_id()
                rows = rows.withColumn(ROW, row).drop(ARRIVAL)
            faulty = F.col(FAULT).isNotNull() if rejecting else F.lit(False)
            found = {"read": F.count(F.lit(1)), "faults": F.count_if(faulty)}
            if self.keys:
                found |= {"widest": F.max(key_bytes(rows.schema, self.keys)), "null_keys": F.count_if(any_null(self.keys))}
                found["distinct"] = F.approx_count_distinct(F.xxhash64(*self.keys), DISTINCT_ERROR)
            seen, schema = Observation(), rows.schema
            paths.append(f"{self.stage}/rows/{number}")
            try:
                rows.observe(seen, *[c.alias(name) for name, c in found.items()]).write.option(*SMALL_FILES).parquet(paths[-1])
            except Exception as error:
                if token not in str(error):
                    raise
                self._stop(checked, limit, reject_path)
            counts = seen.get
            self.read, self.faults = self.read + counts["read"], self.faults + counts["faults"]
            if self.keys:
                widest, null_keys = max(widest, counts["widest"] or 0), null_keys + counts["null_keys"]
                # keys of several waves may be the same ones
                self.surplus = counts["read"] - counts["distinct"] if len(waves) == 1 else 0
            if self.faults >= limit:
                break
        self.whole = number + 1 == len(waves)
        staged = self.spark.read.schema(schema).parquet(*paths)
        faulty = F.col(FAULT).isNotNull()
        self.rows = staged.filter(~faulty).drop(FAULT, ROW_TEXT) if rejecting else staged
        if self.keys:
            self.null_safe = null_keys > 0
            self.broadcast_keys = max(1, BROADCAST_BYTES // (widest or BROADCAST_BYTES))
        if self.faults:
            self.faulty = staged.filter(faulty).select(F.col(FAULT).alias("cause"), F.col(ROW_TEXT).alias("row_text"))

    def _stop(self, checked: Checked, limit: int, reject_path: str | None) -> None:
        """Ends a load one of whose tasks found too many faults; the first ones, looked for in few tasks, are kept."""
        rejects = checked.flagged().filter(F.col(FAULT).isNotNull()).select(F.col(FAULT).alias("cause"), F.col(ROW_TEXT).alias("row_text"))
        shown = rejects.take(min(limit, EARLY_FAULTS))
        path = reject_path or self.sink.default_reject_path()
        kept = self.spark.createDataFrame(shown, "cause string, row_text string")
        kept.coalesce(1).write.parquet(f"{path}/load_id={uuid.uuid4().hex}")
        seen = max(limit, len(shown))
        raise LoadAborted(self.sink.name, LoadReport(self.sink.name, self.read + seen, 0, self.faults + seen, limit, path, False)) from None

    def pick(self) -> None:
        """The last row of each key. Rows of keys that do not repeat stay as they were staged."""
        extra = [c for c in self.rows.columns if c == ROW]
        options = {"order_by": self.order_by, "last": True, "extra": extra, "extra_first": self.arrives}
        accepted = self.read - self.faults
        if accepted > self.broadcast_keys and self.surplus > SURPLUS_SHARE * accepted:
            # so many rows go that telling the repeated keys first costs more than it saves
            self.picked, found = self._park(one_per_key(self.rows, self.keys, **options).drop(COPIES), "picked", n=F.count(F.lit(1)))
            self.n_keys = found["n"]
            return
        repeated, found = self._park(repeated_keys(self.rows, self.keys), "repeated", n=F.count(F.lit(1)), held=F.sum(COPIES))
        n_repeated, held = found["n"], found["held"] or 0
        self.n_keys = accepted - held + n_repeated
        if not n_repeated:
            self.picked = self.rows
        elif n_repeated <= self.broadcast_keys and held < REPEATED_SHARE * accepted:
            rows = with_keys(self.rows, repeated, self.keys, True, self.null_safe)
            several, _ = self._park(one_per_key(rows, self.keys, **options).drop(COPIES), "several")
            self.picked = without_keys(self.rows, repeated, self.keys, True, self.null_safe).unionByName(several)
        else:
            self.picked, _ = self._park(one_per_key(self.rows, self.keys, **options).drop(COPIES), "picked")

    def judge(self) -> None:
        """Says of each row whether its key is in the target, or the row is not the first of its key.

        Keys are counted on their own, with those of the target. Rows are
        shuffled only where the keys in question are too many to broadcast,
        once, and are then written out with what is said of them.
        """
        self.by_key, self.judged = 0, self.rows.withColumn(CAUSE, F.lit(None).cast("string"))
        if self.read == self.faults:
            return
        # where the rows are few, the target's keys are not shuffled
        few = self.read - self.faults <= self.broadcast_keys
        held = self.sink.rows_beside(self.rows, self.keys).select(*self.keys)
        if few:
            held = with_keys(held, self.rows, self.keys, True, self.null_safe)
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        both = self.rows.select(*self.keys, one.alias(COPIES), F.lit(False).alias(HIT)).unionByName(
            held.select(*self.keys, none.alias(COPIES), F.lit(True).alias(HIT))
        )
        counted = both.groupBy(*self.keys).agg(F.sum(COPIES).alias(COPIES), F.max(HIT).alias(HIT))
        in_question = counted.where((F.col(COPIES) > 1) | (F.col(HIT) & (F.col(COPIES) > 0)))
        left_out = F.when(F.col(HIT), F.col(COPIES)).otherwise(F.col(COPIES) - 1)
        troubled, found = self._park(in_question, f"troubled-{uuid.uuid4().hex}", n=F.count(F.lit(1)), out=F.sum(left_out))
        self.by_key = found["out"] or 0
        if not found["n"]:
            return
        if found["n"] <= self.broadcast_keys:
            self.judged = self._judged_by(troubled)
            return
        # fewer keys than may be broadcast have more rows than this, so no task is left with a large key
        cut = self.read // self.broadcast_keys
        hot = troubled.where(F.col(COPIES) > cut)
        cold_rows = without_keys(self.rows, hot, self.keys, True, self.null_safe)
        cold = left_with_key_row(cold_rows, troubled.where(F.col(COPIES) <= cut), self.keys, self.null_safe)
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._compared()))
        cause = F.when(F.col(HIT), F.lit(PRESENT)).when(place > 1, F.lit(REPEATED))
        cold = cold.withColumn(CAUSE, cause).drop(COPIES, HIT)
        hot_rows = self._judged_by(hot).where(F.col(COPIES).isNotNull()).drop(COPIES)
        self.judged, _ = self._park(cold.unionByName(hot_rows), f"judged-{uuid.uuid4().hex}")

    def _compared(self) -> list[str]:
        extra = [c for c in self.rows.columns if c == ROW]
        return compared_columns(self.rows.columns, self.keys, self.order_by, extra, self.arrives)

    def _judged_by(self, troubled: DataFrame) -> DataFrame:
        """The rows with the cause, by keys few enough to be broadcast; the first row of each is found by aggregation."""
        new = troubled.where(~F.col(HIT))
        several = with_keys(self.rows, new, self.keys, True, self.null_safe)
        first = one_per_key(several, self.keys, order_by=self.order_by, extra=[ROW], extra_first=self.arrives).select(*self.keys, COPIES, F.col(ROW).alias(CHOSEN))
        first, _ = self._park(first, f"first-{uuid.uuid4().hex}")
        known = troubled.where(HIT).select(*self.keys, COPIES, F.lit(None).cast(self.rows.schema[ROW].dataType).alias(CHOSEN))
        joined = left_with_key_row(self.rows, F.broadcast(known.unionByName(first)), self.keys, self.null_safe)
        cause = F.when(F.col(COPIES).isNotNull(), F.when(F.col(CHOSEN).isNull(), PRESENT).when(F.col(ROW) != F.col(CHOSEN), REPEATED))
        return joined.withColumn(CAUSE, cause).drop(CHOSEN)

    def finish(self, mode: str, limit: int, reject_path: str | None) -> LoadReport:
        """Decides on keys by what the target holds, keeps the rejects and publishes the rest, or nothing of it."""
        version, _ = self.sink.begin()
        if self.faults < limit and self.keys:
            if mode == "append":
                self.judge()
            elif self.picked is None:
                self.pick()
        report, kept = self.report(limit, reject_path)
        if report.rejected >= limit:
            raise LoadAborted(self.sink.name, report)
        try:
            self.publish(mode, version)
        except CommitConflict:
            # the target holds other keys now, so these rejects may be others too
            if kept is not None:
                drop_path(self.spark, kept)
            raise
        return report

    def accepted(self) -> DataFrame:
        if self.judged is None:
            return self.rows
        return self.judged.where(F.col(CAUSE).isNull()).select(*[c for c in self.rows.columns if c != ROW])

    def _key_rejects(self) -> DataFrame:
        """Every row of a present key, and all but the chosen row of a repeated one."""
        rejected = self.judged.where(F.col(CAUSE).isNotNull())
        columns = [c for c in self.rows.columns if c != ROW]
        target = Target.of(rejected.select(*columns).schema)
        text = row_text([(F.col(c.name), c) for c in target.columns], REJECT_SEPARATOR, self.date_format)
        return rejected.select(F.col(CAUSE).alias("cause"), text.alias("row_text"))

    def report(self, limit: int, reject_path: str | None) -> tuple[LoadReport, str | None]:
        rejected = self.faults + self.by_key
        if not rejected:
            return LoadReport(self.sink.name, self.read, self.read, 0, limit), None
        path = reject_path or self.sink.default_reject_path()
        kinds = ([self.faulty] if self.faults else []) + ([self._key_rejects()] if self.by_key else [])
        rejects = kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1])
        kept = f"{path}/load_id={uuid.uuid4().hex}"
        rejects.write.option(*SMALL_FILES).parquet(kept)
        return LoadReport(self.sink.name, self.read, self.read - rejected, rejected, limit, path, self.whole), kept

    def publish(self, mode: str, version: int) -> None:
        if mode == "append":
            # rows without keys come behind whatever another load did
            guard = {"after": version} if self.keys and isinstance(self.sink, TableSink) else {}
            self.sink.append(self.accepted(), **guard)
        else:
            small = self.n_keys <= self.broadcast_keys
            self.sink.upsert(self.picked.drop(ROW), self.keys, small, self.null_safe)

    def _park(self, rows: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
        """Writes rows out, with counts taken in the stage that writes."""
        path, seen = f"{self.stage}/{name}", Observation()
        counted_rows = rows.observe(seen, *[c.alias(n) for n, c in counts.items()]) if counts else rows
        counted_rows.write.option(*SMALL_FILES).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), seen.get if counts else {}
