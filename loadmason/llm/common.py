"""Small helpers the operators share: work files, columns by name, bounded slices of a batch."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import drop_path, new_path

# Texts are taken in slices of about this many bytes, so that the arrays made
# for a slice stay small. A single longer text is a slice of its own.
SLICE_BYTES = 1 << 20


# Rows of a batch that goes to Python. Texts are long: Spark's default of 10,000
# rows makes batches of tens of megabytes, several of which a task holds at once.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> SparkSession:
    """Sets the session's batches to a size fit for texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{folder}/{name}.parquet")


def park(df: DataFrame, label: str, seen: tuple | None = None) -> DataFrame:
    """Writes rows once in the shared folder and reads them back.

    Whatever follows starts from files every executor can reach, so a lost
    executor costs no earlier step. The files stay until the folder is cleared,
    or ``release`` says that nothing will read them again. ``seen`` holds an
    observation and what it counts in the stage that writes.
    """
    path = new_path(df.sparkSession, label)
    (df if seen is None else df.observe(*seen)).write.parquet(path)
    parked = df.sparkSession.read.schema(df.schema).parquet(path)
    parked.parked_at = path
    return parked


def release(*parked: DataFrame) -> None:
    """Removes the files of parked rows of which nothing lazy is left."""
    for df in parked:
        drop_path(df.sparkSession, df.parked_at)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def give_back() -> None:
    """Returns memory that is free again to the system: the worker goes on to other tasks and stays small between them."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A task's function that gives memory back once all it made is gone."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as bytes; a null text is empty."""
    for batch in batches:
        texts = [b"" if t is None else t for t in batch.column(text).cast(pa.binary()).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > SLICE_BYTES:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t) + 1
        if start < len(texts):
            yield batch.slice(start), texts[start:]
    give_back()
