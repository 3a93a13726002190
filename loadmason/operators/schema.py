"""Schema checks made on the driver, before any job starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaMismatch, TargetMissing
from ..functions.coerce import is_compatible, source_kind
from ..functions.types import EXACT_DECIMAL, STORED_AS, Target, target_type

MODES = ("strict", "loose", "exact")


def check(schema: T.StructType, target, mode: str = "strict") -> None:
    """Raises unless rows of ``schema`` may go into ``target`` by position."""
    target = Target.of(target)
    if mode == "exact":
        check_exact(schema, target)
    elif mode in MODES:
        check_coercible(schema, target, strictly=mode == "strict")
    else:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def check_coercible(schema: T.StructType, target: Target, strictly: bool = True) -> None:
    """Same column count, and every pair in the conversion matrix."""
    check_arity(len(schema.fields), target)
    found = [
        pair_problem(field.name, field.dataType, column.type, strictly)
        for field, column in zip(schema.fields, target.columns)
    ]
    problems = [problem for problem in found if problem]
    if problems:
        raise SchemaMismatch("; ".join(problems))


def check_pair(name: str, given: T.DataType, into: str, strictly: bool) -> None:
    """Raises unless a column of one type may go into a target type."""
    problem = pair_problem(name, given, into, strictly)
    if problem:
        raise SchemaMismatch(problem)


def pair_problem(name: str, given: T.DataType, into: str, strictly: bool) -> str | None:
    kind = source_kind(given)
    if kind is None:
        return f"{name}: {given.simpleString()} is not supported"
    if not is_compatible(kind, into, strictly):
        return f"{name}: {given.simpleString()} is not compatible with {into}"
    return None


def check_exact(schema: T.StructType, target: Target) -> None:
    """The source types must be the target types, in the same order."""
    if not schema.fields or any(not f.name for f in schema.fields):
        raise SchemaMismatch("source column names are missing or empty")
    check_arity(len(schema.fields), target)
    outside = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if target_type(f.dataType) is None]
    if outside:
        raise SchemaMismatch("types outside the accepted ones: " + ", ".join(outside))
    expected = [EXACT_DECIMAL if c.type == "DECIMAL" else STORED_AS[c.type] for c in target.columns]
    actual = [f.dataType for f in schema.fields]
    if actual != expected:
        raise SchemaMismatch(
            f"source types {[t.simpleString() for t in actual]} "
            f"do not match the target's {[t.simpleString() for t in expected]}"
        )


def check_arity(count: int, target: Target) -> None:
    if not len(target):
        raise TargetMissing("the target has no columns")
    if count != len(target):
        raise SchemaMismatch(f"mismatched column counts: expected {len(target)}, actual {count}")


def check_target(spark: SparkSession, table: str | None) -> Target:
    """The schema of a named, existing table with at least one column."""
    if not table or not table.strip():
        raise TargetMissing("no target table is named")
    if not spark.catalog.tableExists(table):
        raise TargetMissing(f"table {table} does not exist")
    target = Target.of(spark.table(table).schema)
    if not len(target):
        raise TargetMissing(f"table {table} has no columns")
    return target


def target_from_columns(columns: DataFrame, table: str) -> Target:
    """A target from a columns listing (table_name, column_name, type_name,
    ordinal_position), matching the table's name in any case."""
    listed = (
        columns.filter(F.lower("table_name") == table.strip().lower())
        .orderBy("ordinal_position")
        .select("column_name", "type_name")
    )
    # one row per column of one table
    pairs = [(row.column_name, row.type_name) for row in listed.collect()]
    if not pairs:
        raise TargetMissing(f"table {table} does not exist")
    return Target.of(pairs)
