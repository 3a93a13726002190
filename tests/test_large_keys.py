"""Queries over keys as large tables have them."""

from datetime import datetime

import duckdb

from loadmason.session import new_path
from queries import QUERIES, SQL

LINEITEM = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def write_lineitem(spark, keys):
    folder = new_path(spark, "tables")
    rest = (1.0, 10.5, 0.0, 0.0, "A", "F", datetime(1995, 1, 1))
    rows = [(order, part, supplier, line, *rest) for order, part, supplier, line in keys]
    spark.createDataFrame(rows, LINEITEM).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_bytes_cells_of_keys_beyond_the_narrow_types(spark):
    """Supplier keys over 2**15, and a difference over 2**31, are cut to the bits shown."""
    keys = [(1, 2, 32_768 + 40, 1), (2, 3, 60_000, 7), (2**31 + 5, 3, 5, 2), (3, 2**33, 65_536 * 3, 3), (4, 1, 0, 1), (5, None, None, 4)]
    folder = write_lineitem(spark, keys)
    found = QUERIES["bytes_cells"](spark, folder)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    want = connection.sql(SQL["bytes_cells"])
    assert sorted(map(repr, found.select(*want.columns).collect())) == sorted(
        repr(r) for r in spark.createDataFrame(want.fetchall(), found.select(*want.columns).schema).collect()
    )
