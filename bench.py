"""Times the headline queries; prints one JSON line.

Each query is run once to warm up and then timed; the result is written to a
sink that discards it, so every row and column is worked out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from loadmason.session import local_session
from queries import QUERIES

HEADLINE = [
    "scan_tsv_typed", "scan_tsv_flagship", "scan_multichar_sep", "scan_null_tokens", "scan_bad_arity", "scan_bad_cells",
    "scan_newline_rows", "render_tsv", "widen_ints", "narrow_long_int", "double_to_ints", "decimal_exact_ints",
    "string_to_all", "bytes_cells", "date_to_all", "md5_forms", "row_diff", "key_diff", "row_fingerprint", "pig_row",
    "exact_insert", "load_append", "append_key_rejects", "append_reject_causes", "load_upsert", "upsert_bucketed",
    "upsert_partitioned", "load_with_rejects", "fault_by_cause", "stage_roundtrip", "store_format", "micro_batch_load",
    "upsert_moved_partition", "upsert_file_order", "scan_small_numbers", "scan_partitioned_folder",
]

# The table whose rows each of these takes through once, for rows a second.
INPUTS = {
    "scan_tsv_typed": "lineitem", "scan_tsv_flagship": "lineitem", "render_tsv": "orders", "widen_ints": "lineitem",
    "decimal_exact_ints": "lineitem", "string_to_all": "part", "bytes_cells": "lineitem", "load_append": "orders",
    "load_upsert": "lineitem", "upsert_partitioned": "lineitem",
}


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in names or HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": {
                    name: round(spark.read.parquet(f"{folder}/{table}.parquet").count() / seconds[name])
                    for name, table in INPUTS.items()
                    if name in seconds
                },
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
