"""Counting, sampling and limiting rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ERRORS = 10


def effective_limit(max_errors: int | str | None) -> int:
    """Zero and below mean the default; text that is no number is an error."""
    if max_errors is None:
        return DEFAULT_MAX_ERRORS
    limit = int(max_errors)
    return limit if limit > 0 else DEFAULT_MAX_ERRORS


def fault_by_cause(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("cause").agg(F.count(F.lit(1)).alias("faults"))


def fault_sample(rejects: DataFrame, max_errors: int | None = None) -> DataFrame:
    """At most as many rejects as the limit allows, for showing to a person."""
    return rejects.limit(effective_limit(max_errors))


def reached_limit(rejects: DataFrame, max_errors: int | None = None) -> bool:
    """Whether there are at least as many rejects as the limit; reads no more than that."""
    limit = effective_limit(max_errors)
    return rejects.limit(limit).count() >= limit


def fault_limit(rejects: DataFrame, max_errors: int | None = None) -> DataFrame:
    """One row: the fault count, the limit and whether it was reached."""
    limit = effective_limit(max_errors)
    return rejects.agg(F.count(F.lit(1)).alias("faults")).select(
        "faults",
        F.lit(limit).cast("bigint").alias("max_errors"),
        (F.col("faults") >= F.lit(limit)).alias("reached"),
    )
