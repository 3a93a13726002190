"""One row per key, and joins of many rows with one row per key.

A single key may hold a large share of all rows. Choosing its row is therefore
an aggregation, which shrinks the key to one row per task before the shuffle,
never a window over the key's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COPIES = "__copies"
PICK = "__pick"

# Types of which equal values are stored alike.
STORED_ALIKE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.BinaryType, T.DateType, T.TimestampType, T.BooleanType)

# Sides up to this many bytes of keys may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def one_per_key(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    last: bool = False,
    extra: Sequence[str] = (),
    extra_first: bool = False,
) -> DataFrame:
    """The first (or last) row of each key by ``order_by``, and how many rows the key has.

    The other columns break ties, so the choice never depends on how the rows
    are spread over tasks. Columns named in ``extra`` are kept; they break
    remaining ties, or with ``extra_first`` those that ``order_by`` leaves. Key
    values come from the chosen row too, so equal ones that are stored
    differently (-0.0) stay as they are.
    """
    keys = list(keys)
    columns = [c for c in rows.columns if c not in extra]
    unknown = [c for c in [*keys, *order_by] if c not in columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    # a key that is stored in one way only is the group's, and not shuffled twice
    same = {k for k in keys if isinstance(rows.schema[k].dataType, STORED_ALIKE) and k in rows.columns}
    compared = [c for c in compared_columns(rows.columns, keys, order_by, extra, extra_first) if c not in same]
    if not compared:
        grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
        return grouped.select(*columns, COPIES)
    picked = F.struct(*[F.col(c) for c in compared])
    pick = F.max(picked) if last else F.min(picked)
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), pick.alias(PICK))
    return grouped.select(*[F.col(c) if c in same else F.col(PICK)[c].alias(c) for c in [*columns, *extra]], COPIES)


def compared_columns(
    columns: Sequence[str], keys: Sequence[str], order_by: Sequence[str], extra: Sequence[str] = (), extra_first: bool = False
) -> list[str]:
    """The columns by which the first of several rows is told, in their order."""
    early, late = (extra, []) if extra_first else ([], extra)
    return list(dict.fromkeys([*order_by, *early, *[c for c in columns if c not in keys and c not in extra], *keys, *late]))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of more than one row, with their number; only keys are shuffled."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES)).where(F.col(COPIES) > 1)


def key_bytes(schema: T.StructType, keys: Sequence[str]) -> Column:
    """An upper estimate of one key's size in memory, with what is kept beside it."""
    size = F.lit(16 * (len(keys) + 4)).cast("bigint")
    for key in keys:
        if isinstance(schema[key].dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(key)), F.lit(0)).cast("bigint")
    return size


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def join_counted(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], total: int, broadcast_keys: int, n_keys: int, null_safe: bool = True
) -> DataFrame:
    """Rows joined with the one row ``per_key`` holds for their key.

    ``per_key`` carries its key's number of rows in ``__copies``; ``total`` is
    the sum. A small ``per_key`` is broadcast. Otherwise keys with more than
    ``total / broadcast_keys`` rows are: there are fewer than
    ``broadcast_keys`` of those. What is left has no large key to skew it.
    """
    if n_keys <= broadcast_keys:
        return _with_key_row(rows, F.broadcast(per_key), keys, null_safe)
    cut = total // max(broadcast_keys, 1)
    hot = per_key.filter(F.col(COPIES) > cut)
    cold = per_key.filter(F.col(COPIES) <= cut)
    joined = _with_key_row(rows, F.broadcast(hot), keys, null_safe)
    cold_rows = without_keys(rows, hot, keys, True, null_safe)
    return joined.unionByName(_with_key_row(cold_rows, cold, keys, null_safe))


def without_keys(rows: DataFrame, listed: DataFrame, keys: Sequence[str], small: bool, null_safe: bool = True) -> DataFrame:
    """Rows whose key is not listed.

    Null keys compare equal where ``null_safe``; say False only if no listed
    key holds a null. Plain equality can use the rows' bucketing; rows with a
    null key then match nothing and are not shuffled.
    """
    listed, on = _renamed(listed.select(*keys), keys, null_safe)
    if small or null_safe:
        return rows.join(F.broadcast(listed) if small else listed, on, "left_anti")
    return rows.where(~any_null(keys)).join(listed, on, "left_anti").unionByName(rows.where(any_null(keys)))


def with_keys(rows: DataFrame, listed: DataFrame, keys: Sequence[str], small: bool, null_safe: bool = True) -> DataFrame:
    """Rows whose key is listed."""
    listed, on = _renamed(listed.select(*keys), keys, null_safe)
    return rows.join(F.broadcast(listed) if small else listed, on, "left_semi")


def _with_key_row(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    renamed, on = _renamed(per_key, keys, null_safe)
    return rows.join(renamed, on).drop(*[f"__k{i}" for i in range(len(keys))])


def left_with_key_row(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """All rows, each with what the one row ``per_key`` holds for its key says beside the key; nulls where there is none."""
    renamed, on = _renamed(per_key, keys, null_safe)
    return rows.join(renamed, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def _renamed(listed: DataFrame, keys: Sequence[str], null_safe: bool) -> tuple[DataFrame, list[Column]]:
    pairs = [(F.col(k), F.col(f"__k{i}")) for i, k in enumerate(keys)]
    on = [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]
    return listed.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)}), on
