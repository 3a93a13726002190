"""Typed rows parked as Parquet, stamped with the signature of their schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaMismatch, SignatureMismatch
from ..functions.types import Target
from ..operators.rows import align_by_position
from ..operators.schema import check_arity

SIGNATURE = "signature"


def write_staged(df: DataFrame, path: str, target=None, mode: str = "errorifexists") -> Target:
    """Writes rows with the schema signature in every file's footer.

    The signature is metadata of the first column, which Parquet keeps with
    the Spark schema, so it costs no column and cannot be lost on its own.
    """
    own = Target.of(df.schema)
    if mode == "append":
        raise ValueError("a staged folder holds one write; stage the next one elsewhere")
    target = Target.of(target) if target is not None else own
    check_arity(len(own), target)
    if own.types != target.types:
        raise SchemaMismatch(f"rows of {own.types} cannot be staged for {target.types}")
    aligned = align_by_position(df, target)
    first = target.names[0]
    stamped = aligned.withColumn(first, F.col(first).alias(first, metadata={SIGNATURE: target.signature}))
    stamped.write.mode(mode).parquet(path)
    return target


def read_staged(spark: SparkSession, path: str, target) -> DataFrame:
    """Reads staged rows back; raises if they were staged for another schema."""
    target = Target.of(target)
    staged = spark.read.parquet(path)
    found = staged_signature(staged.schema)
    if found != target.signature:
        raise SignatureMismatch(f"{path} carries signature {found}, the target has {target.signature}")
    plain = [F.col(c).alias(c, metadata={}) for c in staged.columns]
    return align_by_position(staged.select(*plain), target)


def staged_signature(schema: T.StructType) -> str | None:
    return schema.fields[0].metadata.get(SIGNATURE) if schema.fields else None
