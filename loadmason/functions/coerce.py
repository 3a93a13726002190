"""The type conversion matrix: nine kinds of source by nine target types.

A conversion is a :class:`Cell`: the value as a column expression and, where a
value can be refused at run time, a test for that. Which pairs exist, and
whether they count as strict or only loose, is decided on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaMismatch
from .parsing import (
    PLAIN_TRIM,
    is_misspelt_double,
    is_padded_integer,
    parse_decimal,
    parse_double,
    parse_integer,
    parse_timestamp,
)
from .types import NULL_TOKEN, STORED_AS, TargetColumn

# Target types each kind of source may go to. Loose adds to strict.
STRICT = {
    "byte": {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING", "VARBINARY"},
    "short": {"SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING", "VARBINARY"},
    "int": {"INTEGER", "BIGINT", "FLOAT", "DECIMAL", "STRING", "VARBINARY"},
    "long": {"BIGINT", "DECIMAL", "STRING", "VARBINARY", "TIMESTAMP"},
    "double": {"FLOAT", "DECIMAL", "STRING", "VARBINARY", "TIMESTAMP"},
    "decimal": {"DECIMAL", "STRING"},
    "string": {"STRING", "VARBINARY"},
    "bytes": {"VARBINARY"},
    "date": {"BIGINT", "FLOAT", "DECIMAL", "STRING", "VARBINARY", "TIMESTAMP"},
}
LOOSE = {
    "byte": set(),
    "short": {"TINYINT"},
    "int": {"TINYINT", "SMALLINT"},
    "long": {"TINYINT", "SMALLINT", "INTEGER", "FLOAT"},
    "double": {"TINYINT", "SMALLINT", "INTEGER", "BIGINT"},
    "decimal": {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "VARBINARY", "TIMESTAMP"},
    "string": {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "DECIMAL", "TIMESTAMP"},
    "bytes": {"STRING"},
    "date": set(),
}

# Lowest and highest value of each whole-number type.
BOUNDS = {
    "TINYINT": (-(2**7), 2**7 - 1),
    "SMALLINT": (-(2**15), 2**15 - 1),
    "INTEGER": (-(2**31), 2**31 - 1),
    "BIGINT": (-(2**63), 2**63 - 1),
}
WIDTH = {"byte": 1, "short": 2, "int": 4, "long": 8}

# Spark keeps microseconds in 64 bits, so this is the last whole millisecond.
MAX_MILLIS = (2**63 - 1) // 1000


@dataclass(frozen=True)
class Cell:
    """``value`` converts; ``refused(source, value)`` is true where it must not be used."""

    value: Column
    refused: Callable[[Column, Column], Column] | None = None


def source_kind(spark_type: T.DataType) -> str | None:
    """Which row of the matrix a Spark source type uses, or None if refused."""
    if isinstance(spark_type, T.DecimalType):
        return "decimal"
    if isinstance(spark_type, T.StringType):
        return "string"
    return {
        T.BooleanType(): "byte",
        T.ByteType(): "byte",
        T.ShortType(): "short",
        T.IntegerType(): "int",
        T.LongType(): "long",
        T.FloatType(): "double",
        T.DoubleType(): "double",
        T.BinaryType(): "bytes",
        T.TimestampType(): "date",
        T.TimestampNTZType(): "date",
        T.DateType(): "date",
    }.get(spark_type)


def is_compatible(kind: str, target: str, strictly: bool = True) -> bool:
    return target in STRICT[kind] or (not strictly and target in LOOSE[kind])


def normalized(column: Column, spark_type: T.DataType) -> Column:
    """The source column in the form its row of the matrix works on."""
    if isinstance(spark_type, T.BooleanType):
        return column.cast("tinyint")
    if isinstance(spark_type, T.FloatType):
        return column.cast("double")
    if isinstance(spark_type, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    return column


def to_millis(timestamp: Column) -> Column:
    """A timestamp cut to whole milliseconds."""
    return F.timestamp_millis(F.unix_millis(timestamp))


def convert(
    column: Column,
    spark_type: T.DataType,
    target: TargetColumn,
    date_format: str,
    exact_decimals: bool = False,
) -> Cell:
    """The cell for one source column and one target column.

    Compatibility is not tested here; a pair outside the matrix raises.
    """
    kind = source_kind(spark_type)
    if kind is None or not is_compatible(kind, target.type, strictly=False):
        raise SchemaMismatch(f"{spark_type.simpleString()} is not compatible with {target.type}")
    x = normalized(column, spark_type)
    if kind in WIDTH:
        return _from_integer(x, kind, target)
    if kind == "double":
        return _from_double(x, target, exact_decimals)
    if kind == "decimal":
        return _from_decimal(x, spark_type, target)
    if kind == "string":
        return _from_string(x, target, date_format)
    if kind == "bytes":
        return Cell(x) if target.type == "VARBINARY" else Cell(F.make_valid_utf8(x.cast("string")))
    return _from_date(x, target, date_format)


def pass_through(column: Column, spark_type: T.DataType, target: TargetColumn) -> Cell:
    """The cell of an exact-match insert: nothing changes but timestamps, cut to milliseconds."""
    if target.type == "TIMESTAMP":
        return Cell(to_millis(column))
    if target.type == "DECIMAL":
        return _from_decimal(column, spark_type, target)
    return Cell(column)


def lost(source: Column, value: Column) -> Column:
    return source.isNotNull() & value.isNull()


def is_null_text(text: Column) -> Column:
    """Blank, or the null token with plain white space around it."""
    return F.btrim(text, F.lit(PLAIN_TRIM)).isin("", NULL_TOKEN)


def _from_integer(x: Column, kind: str, target: TargetColumn) -> Cell:
    if target.type in BOUNDS:
        low, high = BOUNDS[target.type]
        if WIDTH[kind] * 8 <= high.bit_length() + 1:
            return Cell(x.cast(target.spark_type))
        # the lowest value is left out: only these narrowings exclude it
        fits = (x > F.lit(low)) & (x <= F.lit(high))
        return Cell(F.when(fits, x.try_cast(target.spark_type)), lost)
    if target.type == "DECIMAL":
        digits = {"byte": 3, "short": 5, "int": 10, "long": 19}[kind]
        roomy = target.spark_type.precision - target.spark_type.scale >= digits
        return Cell(x.try_cast(target.spark_type), None if roomy else lost)
    if target.type == "FLOAT":
        return Cell(x.cast("double"))
    if target.type == "STRING":
        return Cell(x.cast("string"))
    if target.type == "VARBINARY":
        return Cell(_big_endian(x, WIDTH[kind]))
    return _epoch_millis(x)


def _from_double(x: Column, target: TargetColumn, exact_decimals: bool) -> Cell:
    if target.type in BOUNDS:
        low, high = BOUNDS[target.type]
        # tested on the double itself, so 127.5 is refused; NaN sorts above every number
        fits = (x > F.lit(float(low))) & (x <= F.lit(float(high)))
        return Cell(F.when(fits, x.try_cast(target.spark_type)), lost)
    if target.type == "FLOAT":
        return Cell(x)
    if target.type == "DECIMAL":
        value = _exact_decimal(target.spark_type)(x) if exact_decimals else x.try_cast(target.spark_type)
        return Cell(value, lost)
    if target.type == "STRING":
        return Cell(x.cast("string"))
    if target.type == "VARBINARY":
        return Cell(_ieee_bytes(x))
    # seconds, unlike whole numbers and decimals
    return _epoch_millis((x * F.lit(1000)).try_cast("bigint"))


def _from_decimal(x: Column, spark_type: T.DecimalType, target: TargetColumn) -> Cell:
    # compared in the column's own type: any other could round both to fit 38 digits
    whole = x.try_cast("bigint").try_cast(spark_type) == x
    if target.type in BOUNDS:
        return Cell(F.when(whole, x.try_cast(target.spark_type)), lost)
    if target.type == "DECIMAL":
        into = target.spark_type
        room = into.precision - into.scale
        need = spark_type.precision - spark_type.scale + (1 if spark_type.scale > into.scale else 0)
        return Cell(x.try_cast(into), None if need <= room else lost)
    if target.type == "FLOAT":
        return Cell(x.cast("double"))
    if target.type == "STRING":
        return Cell(decimal_text(x, spark_type))
    if target.type == "VARBINARY":
        stored = STORED_AS["DECIMAL"]
        return Cell(_decimal_bytes(x.try_cast(stored)), lost)
    return _epoch_millis(F.when(whole, x.try_cast("bigint")))


def _from_string(x: Column, target: TargetColumn, date_format: str) -> Cell:
    def refused(source, value):
        return lost(source, value) & ~is_null_text(source)

    if target.type in ("STRING", "VARBINARY"):
        kept = F.when(x != F.lit(NULL_TOKEN), x)
        return Cell(kept if target.type == "STRING" else F.encode(kept, "UTF-8"))
    if target.type in BOUNDS:
        return Cell(parse_integer(x, target.spark_type), lambda source, v: refused(source, v) | is_padded_integer(source, v))
    if target.type == "FLOAT":
        return Cell(parse_double(x), lambda source, v: refused(source, v) | is_misspelt_double(source, v))
    if target.type == "DECIMAL":
        return Cell(parse_decimal(F.btrim(x, F.lit(PLAIN_TRIM)), target.spark_type), refused)
    return Cell(parse_timestamp(x, date_format), refused)


def _from_date(x: Column, target: TargetColumn, date_format: str) -> Cell:
    millis = F.unix_millis(x)
    if target.type == "TIMESTAMP":
        return Cell(to_millis(x))
    if target.type == "BIGINT":
        return Cell(millis)
    if target.type == "FLOAT":
        return Cell(millis / F.lit(1000.0))
    if target.type == "STRING":
        return Cell(F.date_format(x, date_format))
    if target.type == "VARBINARY":
        return Cell(_big_endian(millis, 8))
    return _from_integer(millis, "long", target)


def _epoch_millis(millis: Column) -> Cell:
    return Cell(F.when(millis.between(F.lit(-MAX_MILLIS), F.lit(MAX_MILLIS)), F.timestamp_millis(millis)), lost)


def _big_endian(number: Column, width: int) -> Column:
    digits = F.lpad(F.hex(number.cast("bigint")), 16, "0")
    return F.unhex(F.right(digits, F.lit(2 * width)))


@F.arrow_udf(T.BinaryType())
def _ieee_bytes(numbers: pa.Array) -> pa.Array:
    """The 8 bytes of a double, the sign first: whole batches are turned round at once."""
    stored = np.frombuffer(numbers.buffers()[1], dtype=np.float64)[numbers.offset :][: len(numbers)]
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(numbers), [None, pa.py_buffer(stored.astype(">f8"))])
    return pc.if_else(numbers.is_valid(), fixed.cast(pa.binary()), pa.scalar(None, pa.binary()))


@F.arrow_udf(T.BinaryType())
def _decimal_bytes(numbers: pa.Array) -> pa.Array:
    """decimal(38,12) as the 16-byte big-endian two's complement of its unscaled value.

    Arrow holds a decimal as just that in little-endian order, so whole batches
    are turned round without looking at single values.
    """
    stored = np.frombuffer(numbers.buffers()[1], dtype=np.uint8)[16 * numbers.offset :][: 16 * len(numbers)]
    turned = np.ascontiguousarray(stored.reshape(-1, 16)[:, ::-1])
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(numbers), [None, pa.py_buffer(turned)])
    return pc.if_else(numbers.is_valid(), fixed.cast(pa.binary()), pa.scalar(None, pa.binary()))


def decimal_text(number: Column, spark_type: T.DecimalType) -> Column:
    """Decimal digits without the zeros that only pad the column's scale."""
    text = number.cast("string")
    if spark_type.scale == 0:
        return text
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def _exact_decimal(spark_type: T.DecimalType):
    """The full binary expansion of a double, rounded half up to the target's scale.

    Spark's cast starts from the shortest text instead, and no built-in keeps
    the expansion, so this opt-in cell runs in Python.
    """
    step = Decimal(1).scaleb(-spark_type.scale)
    limit = Decimal(10) ** (spark_type.precision - spark_type.scale)
    context = Context(prec=400)

    def expand(number: float):
        if number != number or number in (float("inf"), float("-inf")):
            return None
        value = Decimal(number).quantize(step, rounding=ROUND_HALF_UP, context=context)
        return value if abs(value) < limit else None

    @F.pandas_udf(spark_type)
    def exact(numbers: pd.Series) -> pd.Series:
        return numbers.map(expand)

    return exact
