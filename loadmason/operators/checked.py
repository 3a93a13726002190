"""Rows converted to a target, each with the reason it was refused, if any.

Everything is built as layers of plain projections: fields, values, faults.
A value is named in one layer and tested in the next, so it is computed once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import Cell, convert, pass_through
from ..functions.parsing import pattern_or_default
from ..functions.text_cells import render_field
from ..functions.types import Target, TargetColumn, target_type
from .schema import check, check_pair

FAULT = "__fault"
ROW_TEXT = "__row_text"
ROW = "__row"
REJECT_SEPARATOR = "|"
ARRIVAL = "__arrival"
ON_ERROR = ("fail", "reject", "flag")


class Outcome(NamedTuple):
    accepted: DataFrame
    rejects: DataFrame


class Field(NamedTuple):
    """One target column: its source column in the layer below and its cell."""

    target: TargetColumn
    source: str
    cell: Cell
    message: str


@dataclass(frozen=True)
class Checked:
    layer: DataFrame  # the sources, the values v0, v1, ... and whatever the extras need
    fields: list[Field]
    bad_row: str | None  # column saying why the row as a whole is refused, before its cells; null if it is not
    row_text: Column
    failing_layer: DataFrame | None = None  # the same layer, ending the job on a row refused as a whole
    arrives: bool = False  # whether the layers hold each row's place in its source

    @property
    def can_fault(self) -> bool:
        return self.bad_row is not None or any(f.cell.refused for f in self.fields)

    @property
    def names(self) -> list[str]:
        return [f.target.name for f in self.fields]

    def _refused(self, index: int) -> Column | None:
        field = self.fields[index]
        if field.cell.refused is None:
            return None
        return field.cell.refused(F.col(field.source), F.col(f"v{index}"))

    def _arrival(self, wanted: bool) -> list[str]:
        return [ARRIVAL] if wanted and self.arrives else []

    def flagged(self, arrival: bool = False) -> DataFrame:
        """Every row, with its cause (null when accepted) and, if refused, its text."""
        tests = {f"r{i}": test for i in range(len(self.fields)) if (test := self._refused(i)) is not None}
        tested = self.layer.withColumns(tests)
        fault = F.lit(None).cast("string")
        if tests:
            causes = [F.when(F.col(name), F.lit(self.fields[int(name[1:])].message)) for name in tests]
            fault = F.when(reduce(or_, [F.col(name) for name in tests]), F.concat_ws("; ", *causes))
        if self.bad_row is not None:
            fault = F.coalesce(F.col(self.bad_row), fault)
        values = [F.col(f"v{i}").alias(f.target.name) for i, f in enumerate(self.fields)]
        shown = F.when(F.col(FAULT).isNotNull(), self.row_text)
        return tested.withColumn(FAULT, fault).select(*values, FAULT, shown.alias(ROW_TEXT), *self._arrival(arrival))

    def failing(self, arrival: bool = False) -> DataFrame:
        """The converted rows; reading a refused one ends the job with its cause.

        The test sits in each column, so a column nobody reads is neither
        computed nor tested.
        """
        columns = []
        for index, field in enumerate(self.fields):
            value = F.col(f"v{index}")
            refused = self._refused(index)
            if refused is not None:
                shown = F.concat_ws(": ", F.lit(field.message), F.col(field.source).cast("string"))
                value = F.when(refused, F.raise_error(shown)).otherwise(value)
            columns.append(value.cast(field.target.spark_type).alias(field.target.name))
        layer = self.layer if self.failing_layer is None else self.failing_layer
        return layer.select(*columns, *self._arrival(arrival))

    def outcome(self) -> Outcome:
        """Accepted rows and rejects, each read from the source on its own.

        Where that costs too much, or the source may change between the two,
        take the one flagged frame instead and write it out. The row number keeps Spark from moving the filter below the layers,
        which would work out every value again inside the filter.
        """
        numbered = self.flagged().withColumn(ROW, F.monotonically_increasing_id())
        return split(numbered.filter(F.col(ROW) >= 0))

    def frame(self, on_error: str):
        if on_error not in ON_ERROR:
            raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
        if on_error == "flag":
            return self.flagged()
        return self.failing() if on_error == "fail" else self.outcome()


def split(flagged: DataFrame) -> Outcome:
    """Accepted rows, and rejects as (cause, row_text)."""
    return Outcome(
        flagged.filter(F.col(FAULT).isNull()).drop(FAULT, ROW_TEXT, ROW),
        flagged.filter(F.col(FAULT).isNotNull()).select(
            F.col(FAULT).alias("cause"), F.col(ROW_TEXT).alias("row_text")
        ),
    )


def row_text(columns: list[tuple[Column, TargetColumn]], sep: str, date_format: str) -> Column:
    return F.concat_ws(sep, *[render_field(value, column, date_format) for value, column in columns])


def convert_frame(
    df: DataFrame, target, mode: str = "strict", date_format: str | None = None, exact_decimals: bool = False
) -> Checked:
    """Matches ``df`` to ``target`` by position and converts every column."""
    target = Target.of(target)
    check(df.schema, target, mode)
    date_format = pattern_or_default(date_format)
    sources = [f"s{i}" for i in range(len(target))]
    positional = df.toDF(*sources)
    fields, values, texts = [], [], []
    for source, given, column in zip(sources, df.schema.fields, target.columns):
        if mode == "exact":
            cell = pass_through(F.col(source), given.dataType, column)
        else:
            cell = convert(F.col(source), given.dataType, column, date_format, exact_decimals)
        message = f"{column.name}: {given.dataType.simpleString()} does not fit {column.type}"
        fields.append(Field(column, source, cell, message))
        values.append(cell.value.alias(f"v{len(values)}"))
        shown = target_type(given.dataType) or "STRING"
        as_text = F.col(source).cast("string") if shown == "STRING" else F.col(source)
        texts.append((as_text, TargetColumn(source, shown, given.dataType)))
    return Checked(
        positional.select(*sources, *values), fields, None, row_text(texts, REJECT_SEPARATOR, date_format)
    )


def convert_columns(
    df: DataFrame,
    conversions: Sequence[tuple[str, Column, str]],
    keep: Sequence[str] = (),
    date_format: str | None = None,
    strictly: bool = False,
) -> DataFrame:
    """Converts single columns, given as (new name, source, target type).

    Each yields the value, null where it was refused, and ``<name>_refused``.
    """
    date_format = pattern_or_default(date_format)
    sources = [f"__s{i}" for i in range(len(conversions))]
    layer = df.select(*keep, *[source.alias(s) for s, (_, source, _) in zip(sources, conversions)])
    values, flags = [], []
    for source, (name, _, into) in zip(sources, conversions):
        given = layer.schema[source].dataType
        column = Target.of([(name, into)]).columns[0]
        check_pair(name, given, column.type, strictly)
        cell = convert(F.col(source), given, column, date_format)
        values.append(cell.value.alias(name))
        if cell.refused:
            refused = cell.refused(F.col(source), F.col(name))
            flags += [F.when(~refused, F.col(name)).alias(name), refused.alias(f"{name}_refused")]
        else:
            flags += [F.col(name), F.lit(False).alias(f"{name}_refused")]
    return layer.select(*keep, *sources, *values).select(*keep, *flags)


def coerce(
    df: DataFrame,
    target,
    mode: str = "strict",
    on_error: str = "fail",
    date_format: str | None = None,
    exact_decimals: bool = False,
):
    """``df`` in the target's schema; with ``on_error="reject"`` an :class:`Outcome`.

    With ``on_error="flag"`` it is one frame: the columns, null where refused,
    ``__fault`` (why, or null) and ``__row_text``. Filters on columns that are
    passed on as they are reach the scan.
    """
    return convert_frame(df, target, mode, date_format, exact_decimals).frame(on_error)
