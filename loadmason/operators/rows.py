"""Whole-row operators: alignment by position, comparison, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import SchemaMismatch
from ..functions.types import Target
from .schema import check_arity


# Buckets of keys that a level of digests tells apart.
DIGEST_BUCKETS = 4096


def align_by_position(df: DataFrame, target) -> DataFrame:
    """The same columns under the target's names; source names do not matter."""
    target = Target.of(target)
    check_arity(len(df.columns), target)
    return df.toDF(*target.names)


def row_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows the two frames do not share, with how many more copies one side holds.

    One shuffle: both sides are counted together, so equal rows cancel out and
    a row repeated any number of times reaches a reducer once per task. Null
    equals null, binary goes by content, and doubles by value: -0.0 is 0.0.
    """
    names = left.columns
    if len(right.columns) != len(names):
        raise SchemaMismatch(f"mismatched column counts: {len(names)} and {len(right.columns)}")
    both = left.withColumn("__side", F.lit(1).cast("bigint")).unionAll(
        right.toDF(*names).withColumn("__side", F.lit(-1).cast("bigint"))
    )
    balance = both.groupBy(*names).agg(F.sum("__side").alias("__side")).filter(F.col("__side") != 0)
    return balance.select(
        *names,
        F.when(F.col("__side") > 0, F.lit("left")).otherwise(F.lit("right")).alias("only_in"),
        F.abs("__side").alias("copies"),
    )


def differing(left: DataFrame, right: DataFrame, keys: Sequence[str], levels: int = 1) -> tuple[DataFrame, DataFrame]:
    """Both frames without most rows that they share, told apart by digests of buckets of keys.

    A digest is the number of a bucket's rows and 128 bits of sums of their
    hashes, so the order of rows plays no part and equal rows count as often as
    they come. What is shuffled is one row a bucket and task. Only buckets whose
    digests differ go on to the next level, which cuts each of them into as
    many again. Two buckets that differ have equal digests once in 2^128 times.
    """
    names, keys = left.columns, list(keys)
    if len(right.columns) != len(names):
        raise SchemaMismatch(f"mismatched column counts: {len(names)} and {len(right.columns)}")
    sides = [left, right.toDF(*names)]
    for level in range(levels):
        bucket = F.pmod(F.xxhash64(F.lit(level), *keys, *[F.col(k).isNull() for k in keys]), F.lit(DIGEST_BUCKETS))
        both = _halves(sides[0], bucket, 1).unionAll(_halves(sides[1], bucket, -1))
        sums = both.groupBy("__bucket").agg(*[F.sum(c).alias(c) for c in both.columns if c != "__bucket"])
        unequal = reduce(or_, [F.col(c) != 0 for c in sums.columns if c != "__bucket"])
        # as many as there are buckets at most
        listed = F.broadcast(sums.where(unequal).select("__bucket"))
        sides = [side.withColumn("__bucket", bucket).join(listed, "__bucket", "left_semi").select(*names) for side in sides]
    return sides[0], sides[1]


def _halves(rows: DataFrame, bucket: Column, sign: int) -> DataFrame:
    """The bucket of each row, and its digest in parts whose sums do not overflow."""
    columns = [F.col(c) for c in rows.columns]
    nulls = [c.isNull() for c in columns]
    hashed = rows.select(bucket.alias("__bucket"), *[F.xxhash64(F.lit(salt), *columns, *nulls).alias(f"__h{salt}") for salt in (1, 2)])
    parts = [part for h in ("__h1", "__h2") for part in (F.shiftright(h, 32), F.col(h).bitwiseAND(F.lit((1 << 32) - 1)))]
    return hashed.select(
        "__bucket", F.lit(sign).cast("bigint").alias("__n"), *[(part * sign).cast("bigint").alias(f"__s{i}") for i, part in enumerate(parts)]
    )


def key_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], digest_levels: int = 0) -> DataFrame:
    """Keys whose rows differ: added, removed or changed, and which columns changed.

    Rows found on both sides are cancelled out first. ``columns`` is filled
    where the key has exactly one differing row on each side. For large tables
    with few differences ``digest_levels`` reads them that many times more and
    shuffles only rows near a difference; see :func:`differing`.
    """
    keys = list(keys)
    if digest_levels:
        left, right = differing(left, right, keys, digest_levels)
    rest = [c for c in left.columns if c not in keys]
    unshared = row_diff(left, right)
    on_left = F.col("only_in") == "left"
    sides = [
        F.sum(F.when(on_left, F.col("copies")).otherwise(0)).alias("left_rows"),
        F.sum(F.when(on_left, 0).otherwise(F.col("copies"))).alias("right_rows"),
    ]
    # a side with several rows shows only one of them; its columns are not compared
    for index, name in enumerate(rest):
        sides.append(F.max(F.when(on_left, F.col(name))).alias(f"__left{index}"))
        sides.append(F.max(F.when(~on_left, F.col(name))).alias(f"__right{index}"))
    per_key = unshared.groupBy(*keys).agg(*sides)
    changed = F.concat_ws(
        ",",
        *[
            F.when(~F.col(f"__left{i}").eqNullSafe(F.col(f"__right{i}")), F.lit(name))
            for i, name in enumerate(rest)
        ],
    )
    return per_key.select(
        *keys,
        F.when(F.col("left_rows") == 0, "added")
        .when(F.col("right_rows") == 0, "removed")
        .otherwise("changed")
        .alias("change"),
        F.when((F.col("left_rows") == 1) & (F.col("right_rows") == 1), changed).alias("columns"),
        "left_rows",
        "right_rows",
    )


def fingerprint(columns: Sequence[Column], table: str = "") -> Column:
    """A 64-bit hash of a row and its table. Null marks are hashed too, since the
    hash itself skips nulls and would not see in which column one stands."""
    return F.xxhash64(*columns, *[c.isNull() for c in columns], F.lit(table))


def row_fingerprint(df: DataFrame, table: str = "", name: str = "fingerprint") -> DataFrame:
    return df.withColumn(name, fingerprint([F.col(c) for c in df.columns], table))
