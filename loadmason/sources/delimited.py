"""Delimited text with a schema fixed by the target. No quoting, no escaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import UNICODE_SPACE, pattern_or_default
from ..functions.text_cells import parse_field
from ..functions.types import DEFAULT_SEPARATOR, Target
from ..operators.checked import ARRIVAL, Checked, Field, row_text
from ..operators.schema import check_arity


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, arrival: bool = False, files: Sequence[str] | None = None
) -> DataFrame:
    """The lines of a file, a folder or several of them.

    Sub-folders named like ``dt=1`` are read as well, any others with
    ``recursive``. With ``arrival`` each line has its place: file, where its
    stretch of the file starts, and a number that rises within the stretch.
    With ``files`` only those among them are opened.
    """
    lines = _reader(spark, recursive).text(paths if isinstance(paths, str) else list(paths))
    if files is not None:
        lines = lines.where(F.col("_metadata.file_path").isin(list(files)))
    if not arrival:
        return lines.select("value")
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("number"),
    )
    return lines.select("value", place.alias(ARRIVAL))


def listed_files(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """``path``, ``size`` and ``modified`` of the files that :func:`read_lines` would read; none is opened."""
    files = _reader(spark, recursive).format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    names = {"path": "file_path", "size": "file_size", "modified": "file_modification_time"}
    return files.select(*[F.col(f"_metadata.{name}").alias(short) for short, name in names.items()])


def new_files(spark: SparkSession, listed: DataFrame, ledgers: Sequence[str]) -> DataFrame:
    """The listed files that no ledger has with the same size and time."""
    if not ledgers:
        return listed
    return listed.join(spark.read.schema(listed.schema).parquet(*ledgers), listed.columns, "left_anti")


def _reader(spark: SparkSession, recursive: bool):
    return spark.read.option("recursiveFileLookup", "true") if recursive else spark.read


def split_pattern(sep: str) -> str:
    """A regular expression for a literal separator.

    One character is kept or escaped with one backslash: those are the forms
    Java splits without compiling a pattern for every line.
    """
    return "".join(c if c.isalnum() or ord(c) > 127 or c.isspace() else "\\" + c for c in sep)


def trimmed_parts(line: Column, sep: str) -> tuple[Column, Callable[[Column], Column]]:
    """The parts of a line, and what still trims a single part.

    Trimming plain spaces is far cheaper than trimming a set of characters, so
    other white space is taken off the whole line beforehand, from the lines
    that have any. Byte searches tell so for plain ASCII; only other lines need
    the search for a set of characters.
    """
    pattern = split_pattern(sep)
    if len(sep) > 1 and any(c in UNICODE_SPACE for c in sep):
        # white space at a part's edge may look like a piece of the separator
        return F.split(line, pattern, -1), lambda part: F.btrim(part, F.lit(UNICODE_SPACE))
    space = "".join(c for c in UNICODE_SPACE if c != sep)
    # the separators of Unicode and the next-line character are the white space beyond ASCII
    kept = sep if sep in UNICODE_SPACE else ""
    wide = f"[\\x85[\\p{{Z}}&&[^ {kept}]]]"
    not_ascii = F.octet_length(line) != F.char_length(line)
    narrow = [line.contains(c) for c in space if ord(c) < 128 and c != " "]
    unusual = reduce(or_, narrow, not_ascii & line.rlike(wide))
    clean = F.regexp_replace(F.btrim(line, F.lit(space)), f"[{space}]*{pattern}[{space}]*", quote_replacement(sep))
    return F.split(F.when(unusual, clean).otherwise(line), pattern, -1), F.trim


def quote_replacement(sep: str) -> str:
    return sep.replace("\\", "\\\\").replace("$", "\\$")


def check_lines(
    lines: DataFrame, target, sep: str | None = DEFAULT_SEPARATOR, date_format: str | None = None
) -> Checked:
    """Splits each line of a one-column frame and reads field *i* as target column *i*.

    The frame may also hold each line's place in its source.
    """
    target = Target.of(target)
    check_arity(len(target), target)
    date_format = pattern_or_default(date_format)
    sep = sep or DEFAULT_SEPARATOR
    parts, trim = trimmed_parts(F.col("line"), sep)
    fields, trimmed, values = [], [], []
    for index, column in enumerate(target.columns):
        source = f"s{index}"
        trimmed.append(trim(F.get("parts", F.lit(index))).alias(source))
        cell = parse_field(F.col(source), column, date_format)
        fields.append(Field(column, source, cell, f"{column.name}: not a valid {column.type}"))
        values.append(cell.value.alias(f"v{index}"))
    sources = [f.source for f in fields]
    arity = F.size("parts")
    wrong = arity != len(target)
    mismatch = F.concat(F.lit(f"mismatched field counts: expected {len(target)}, actual "), arity.cast("string"))
    arrival = [c for c in lines.columns if c == ARRIVAL]
    text = next(c for c in lines.columns if c != ARRIVAL)
    given = lines.withColumnRenamed(text, "line").select("line", parts.alias("parts"), *arrival)
    reporting = given.select("line", F.when(wrong, mismatch).alias("bad_row"), *trimmed, *arrival)
    # ending the job is part of every field, so it holds for whichever are read
    guarded = given.select(F.when(wrong, F.raise_error(mismatch)).otherwise(F.col("parts")).alias("parts"), *arrival)
    return Checked(
        reporting.select("line", "bad_row", *sources, *values, *arrival),
        fields,
        "bad_row",
        F.col("line"),
        guarded.select(*trimmed, *arrival).select(*sources, *values, *arrival),
        bool(arrival),
    )


def parse_lines(lines: DataFrame, target, sep: str | None = DEFAULT_SEPARATOR, date_format: str | None = None, on_error: str = "fail"):
    return check_lines(lines, target, sep, date_format).frame(on_error)


def scan_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    target,
    sep: str | None = DEFAULT_SEPARATOR,
    date_format: str | None = None,
    on_error: str = "fail",
    recursive: bool = False,
):
    """A typed frame from text files; with ``on_error="reject"`` accepted rows and rejects."""
    return parse_lines(read_lines(spark, paths, recursive), target, sep, date_format, on_error)


def render(
    df: DataFrame, target=None, sep: str | None = DEFAULT_SEPARATOR, date_format: str | None = None
) -> DataFrame:
    """One text column ``value`` holding each row as a separated line."""
    own = Target.of(df.schema)
    if target is not None:
        check_arity(len(own), Target.of(target))
    positional = df.toDF(*[f"s{i}" for i in range(len(own))])
    columns = [(F.col(f"s{i}"), column) for i, column in enumerate(own.columns)]
    line = row_text(columns, sep or DEFAULT_SEPARATOR, pattern_or_default(date_format))
    return positional.select(line.alias("value"))


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str | None = DEFAULT_SEPARATOR,
    date_format: str | None = None,
    target=None,
    mode: str = "errorifexists",
    compression: str | None = None,
) -> None:
    writer = render(df, target, sep, date_format).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
