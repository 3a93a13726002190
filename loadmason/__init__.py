"""Typed bulk loading on Spark: scan, convert, check, load, render, stage."""

from .errors import CommitConflict, LoadAborted, SchemaMismatch, SignatureMismatch, TargetMissing
from .functions.types import Target
from .operators.checked import coerce, convert_columns
from .operators.faults import fault_by_cause, fault_limit, fault_sample, reached_limit
from .operators.rows import align_by_position, key_diff, row_diff, row_fingerprint
from .operators.schema import check, check_target, target_from_columns
from .plans.load import LoadReport, insert_exact, load, load_file, load_jdbc, store
from .plans.sinks import create_table
from .session import ship
from .sources.delimited import parse_lines, read_lines, render, scan_delimited, write_delimited
from .sources.staged import read_staged, write_staged
from .streaming.keyed import load_keyed_stream
from .streaming.micro_batch import load_stream

__all__ = [
    "CommitConflict", "LoadAborted", "LoadReport", "SchemaMismatch", "SignatureMismatch", "Target", "TargetMissing",
    "align_by_position", "check", "check_target", "coerce", "convert_columns", "create_table", "fault_by_cause",
    "fault_limit", "fault_sample", "insert_exact", "key_diff", "load", "load_file", "load_jdbc",
    "load_keyed_stream", "load_stream", "parse_lines", "reached_limit", "read_lines", "read_staged", "render", "row_diff",
    "row_fingerprint", "scan_delimited", "store", "target_from_columns", "write_delimited", "write_staged",
]

ship()
