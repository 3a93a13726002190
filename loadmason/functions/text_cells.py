"""One text field in, one text field out, for each target type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import BOUNDS, Cell, decimal_text, lost
from .parsing import is_misspelt_double, is_padded_integer, parse_decimal, parse_double, parse_integer, parse_timestamp
from .types import NULL_TOKEN, TargetColumn


def parse_field(field: Column, target: TargetColumn, date_format: str) -> Cell:
    """Reads an already trimmed field. Binary is hex here, unlike in coercion."""
    if target.type == "STRING":
        return Cell(F.when(field != F.lit(NULL_TOKEN), field))
    if target.type == "VARBINARY":
        pairs = F.substring(field, F.lit(1), F.length(field) - F.length(field) % 2)
        value = F.when(field != F.lit(NULL_TOKEN), F.unhex(pairs))
        return Cell(value, lambda source, v: lost(source, v) & (source != F.lit(NULL_TOKEN)))

    def refused(source, value):
        return lost(source, value) & ~source.isin("", NULL_TOKEN)

    if target.type in BOUNDS:
        return Cell(parse_integer(field, target.spark_type), lambda source, v: refused(source, v) | is_padded_integer(source, v))
    if target.type == "FLOAT":
        return Cell(parse_double(field), lambda source, v: refused(source, v) | is_misspelt_double(source, v))
    if target.type == "DECIMAL":
        return Cell(parse_decimal(field, target.spark_type), refused)
    return Cell(parse_timestamp(field, date_format), refused)


def render_field(value: Column, target: TargetColumn, date_format: str) -> Column:
    """Writes a value as text; never null. Nothing is quoted or escaped."""
    if target.type == "STRING":
        return F.coalesce(value, F.lit(NULL_TOKEN))
    if target.type == "VARBINARY":
        return F.coalesce(F.lower(F.hex(value)), F.lit(NULL_TOKEN))
    if target.type == "TIMESTAMP":
        text = F.date_format(value, date_format)
    elif target.type == "DECIMAL":
        text = decimal_text(value, target.spark_type)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))
