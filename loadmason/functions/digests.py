"""MD5 forms of a string or binary column (null stays null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bytes(content: Column) -> Column:
    return F.unhex(F.md5(content))


def md5_base64(content: Column) -> Column:
    return F.base64(md5_bytes(content))


def md5_uuid(content: Column) -> Column:
    return F.regexp_replace(F.md5(content), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
