"""The file-load job: options in, one load, an exit code out.

Ends with a non-zero exit code when the load fails or is aborted.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..operators.faults import DEFAULT_MAX_ERRORS
from ..session import tune
from .load import load_file


def parse(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loadmason", description="Loads delimited files into a table.")
    parser.add_argument("file", help="a file or folder of delimited lines")
    parser.add_argument("table", help="the table to load")
    parser.add_argument("--sep", default="\t", help="literal field separator (default: TAB)")
    parser.add_argument("--date-format", help="timestamp pattern")
    parser.add_argument("--upsert", action="store_true", help="replace rows with the same key")
    parser.add_argument("--keys", default="", help="comma-separated key columns")
    parser.add_argument("--order-by", default="", help="comma-separated columns that order rows of one key")
    parser.add_argument("--on-error", choices=("fail", "reject"), default="fail")
    parser.add_argument("--max-errors", type=int, default=DEFAULT_MAX_ERRORS)
    parser.add_argument("--once", action="store_true", help="leave out files this table has loaded before")
    parser.add_argument("--reject-path", help="folder for rejected rows")
    return parser.parse_args(argv)


def names(listed: str) -> list[str]:
    """Names of a comma-separated list, without blanks."""
    return [name.strip() for name in listed.split(",") if name.strip()]


def main(argv=None) -> int:
    options = parse(argv)
    spark = tune(SparkSession.builder.appName("loadmason").getOrCreate())
    try:
        report = load_file(
            spark,
            options.file,
            options.table,
            mode="upsert" if options.upsert else "append",
            keys=names(options.keys),
            order_by=names(options.order_by),
            sep=options.sep,
            date_format=options.date_format,
            on_error=options.on_error,
            max_errors=options.max_errors,
            reject_path=options.reject_path,
            once=options.once,
        )
    except Exception as error:
        print(f"load of {options.file} into {options.table} failed: {error}", file=sys.stderr)
        return 1
    print(f"{report.table}: read {report.read}, loaded {report.loaded}, rejected {report.rejected}")
    return 0

