"""Strict text-to-value expressions shared by the text scan and string coercion.

Each returns null for text it cannot read; callers decide whether that null is
a fault or one of the null tokens. Spark's own casts trim, and accept spellings
such as ``inf``, so the form of the text is tested as well, before or after.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import DEFAULT_DATE_FORMAT, NULL_TOKEN

# The characters a plain trim removes (code points 0 to 32), and
# the Unicode white space removed around each field of a text line.
PLAIN_TRIM = "".join(chr(c) for c in range(0x21))
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

_INTEGER = r"^[+-]?[0-9]+\z"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
_SPECIAL = r"(?i)^[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*\z"
_SPECIAL_ACCEPTED = r"^[\x00-\x20]*[+-]?(Infinity|NaN)[\x00-\x20]*\z"
_DEFAULT_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{1,3}\z"


def parse_integer(text: Column, spark_type: T.DataType) -> Column:
    # the cast raises and catches an error for other text, which takes a hundred times
    # as long as reading a number; null tokens and words go no further than this
    numeric = (text >= "+") & (text < ":")
    return F.when(numeric, text.try_cast(spark_type))


def is_padded_integer(text: Column, number: Column) -> Column:
    """Whether text the cast took as a whole number is more than digits and a sign.

    Most numbers print as they were written, which is quicker to see than a
    pattern is to match.
    """
    return number.isNotNull() & (number.cast("string") != text) & ~text.rlike(_INTEGER)


def parse_double(text: Column) -> Column:
    # the cast raises and catches an error for text that is no number, so the
    # usual ways to write a null are kept from it
    return F.when(~text.isin("", NULL_TOKEN), text.try_cast("double"))


def is_misspelt_double(text: Column, number: Column) -> Column:
    """Whether text the cast took as a special number is spelt in another way than
    ``NaN`` or ``Infinity``."""
    odd = F.isnan(number) | (F.abs(number) == float("inf"))
    return number.isNotNull() & odd & text.rlike(_SPECIAL) & ~text.rlike(_SPECIAL_ACCEPTED)


def parse_decimal(text: Column, spark_type: T.DecimalType) -> Column:
    return F.when(text.rlike(_DECIMAL), text.try_cast(spark_type))


def parse_timestamp(text: Column, date_format: str) -> Column:
    if date_format == DEFAULT_DATE_FORMAT:
        # the cast reads this one shape several times faster than a pattern does
        return F.when(text.rlike(_DEFAULT_TIMESTAMP), text.try_cast("timestamp"))
    return F.try_to_timestamp(text, F.lit(date_format))


def pattern_or_default(date_format: str | None) -> str:
    return date_format if date_format and date_format.strip() else DEFAULT_DATE_FORMAT
