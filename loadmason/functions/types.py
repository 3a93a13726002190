"""The nine target types, their Spark counterparts and the target schema."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

from ..errors import SchemaMismatch

# The nine target types and the Spark type each is stored as.
# FLOAT is an 8-byte number.
STORED_AS = {
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "STRING": T.StringType(),
    "VARBINARY": T.BinaryType(),
    "DECIMAL": T.DecimalType(38, 12),
}

# Fixed value: the decimal type demanded by an exact-match insert.
EXACT_DECIMAL = T.DecimalType(26, 12)

DEFAULT_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DEFAULT_SEPARATOR = "\t"
NULL_TOKEN = "\\N"


def target_type(spark_type: T.DataType) -> str | None:
    """The target type a Spark column type stands for, or None outside the nine."""
    if isinstance(spark_type, T.DecimalType):
        return "DECIMAL"
    if isinstance(spark_type, T.StringType):
        return "STRING"
    for name, stored in STORED_AS.items():
        if spark_type == stored:
            return name
    return None


@dataclass(frozen=True)
class TargetColumn:
    name: str
    type: str
    spark_type: T.DataType


@dataclass(frozen=True)
class Target:
    """An ordered list of typed columns; sources are matched to it by position."""

    columns: tuple[TargetColumn, ...]

    @classmethod
    def of(cls, spec) -> Target:
        """Builds a target from a Target, a Spark schema, ``"a INTEGER, b STRING"``
        or pairs of column name and target type name."""
        if isinstance(spec, Target):
            return spec
        if isinstance(spec, T.StructType):
            return cls._from_schema(spec)
        if isinstance(spec, str):
            spec = [part.split() for part in spec.split(",") if part.strip()]
        return cls._from_pairs(spec)

    @classmethod
    def _from_schema(cls, schema: T.StructType) -> Target:
        unsupported = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if target_type(f.dataType) is None]
        if unsupported:
            raise SchemaMismatch("unsupported target column types: " + ", ".join(unsupported))
        return cls(tuple(TargetColumn(f.name, target_type(f.dataType), f.dataType) for f in schema.fields))

    @classmethod
    def _from_pairs(cls, pairs: Iterable) -> Target:
        columns = []
        for pair in pairs:
            if len(pair) != 2:
                raise SchemaMismatch(f"expected a column name and a type, got {pair!r}")
            name, type_name = pair[0], pair[1].upper()
            if type_name not in STORED_AS:
                raise SchemaMismatch(f"unsupported target column type {type_name!r} of {name!r}")
            columns.append(TargetColumn(name, type_name, STORED_AS[type_name]))
        return cls(tuple(columns))

    def __len__(self) -> int:
        return len(self.columns)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def types(self) -> list[str]:
        return [c.type for c in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns])

    @property
    def signature(self) -> str:
        """MD5 of the type names in column order, written as a UUID."""
        return str(uuid.UUID(hashlib.md5("".join(self.types).encode("utf-8")).hexdigest()))
