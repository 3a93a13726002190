from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import loadmason as lm
from loadmason.functions.parsing import UNICODE_SPACE

THINGS = "fi INTEGER, fl BIGINT, fd FLOAT, fs STRING, ft TIMESTAMP, fb VARBINARY"
AT = datetime(1999, 12, 31, 23, 58, 7, 40000)
D, X = "1999-12-31 23:58:07.040", "00ff10"

# One line for each rule of a field: plain, empty, null token, padded, unusual.
GOOD = [
    (f"-17\t9000000000\t0.125\tgrey heron\t{D}\t{X}", (-17, 9000000000, 0.125, "grey heron", AT, b"\x00\xff\x10")),
    (f"0\t\\N\t-2e3\t\t\t{X.upper()}", (0, None, -2000.0, "", None, b"\x00\xff\x10")),
    ("\t\t\t\\N\t\\N\t\\N", (None, None, None, None, None, None)),
    (f" 8 \t+6\t 1.5 \t  two  words \t {D} \t", (8, 6, 1.5, "two  words", AT, b"")),
    (f"2147483647\t-1\t7.\t{{}}\t{D}\t}}", (2147483647, -1, 7.0, "{}", AT, b"")),
]
BAD = [
    ("5\t6", "mismatched field counts: expected 6, actual 2"),
    ("", "mismatched field counts: expected 6, actual 1"),
    (f"5\t6\t7\tx\t{D}\t{X}\t", "mismatched field counts: expected 6, actual 7"),
    ("\t" * 300, "mismatched field counts: expected 6, actual 301"),
    (f"5\t6\tx\t7\t{D}\t{X}", "fd: not a valid FLOAT"),
    (f"5\t6\t7\tx\tyesterday\t{X}", "ft: not a valid TIMESTAMP"),
    (f"5\t6\t7\tx\t{D}\t0g", "fb: not a valid VARBINARY"),
    (f"5.0\tsix\tInf\tx\t{D}\t", "fi: not a valid INTEGER; fl: not a valid BIGINT; fd: not a valid FLOAT"),
]


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_good_lines(spark):
    out = lm.parse_lines(lines(spark, [line for line, _ in GOOD]), THINGS)
    assert rows(out) == sorted([row for _, row in GOOD], key=repr)


def test_bad_lines_become_rejects(spark):
    accepted, rejects = lm.parse_lines(lines(spark, [line for line, _ in GOOD + BAD]), THINGS, on_error="reject")
    assert rows(accepted) == sorted([row for _, row in GOOD], key=repr)
    assert rows(rejects) == sorted([(cause, line) for line, cause in BAD], key=repr)


@pytest.mark.parametrize("line,cause", BAD)
def test_bad_lines_fail_by_default(spark, line, cause):
    with pytest.raises(Exception, match=cause.split(";")[0]):
        lm.parse_lines(lines(spark, [line]), THINGS).collect()


def test_unread_columns_are_not_tested(spark):
    bad = lines(spark, [f"5\t6\tx\ty\t{D}\t{X}"])
    assert rows(lm.parse_lines(bad, THINGS).select("fi")) == [(5,)]


def test_files_and_folders(spark, tmp_path):
    (tmp_path / "a").write_text("\n".join(line for line, _ in GOOD[:3]) + "\n")
    (tmp_path / "b").write_text("\r\n".join(line for line, _ in GOOD[3:]))
    want = sorted([row for _, row in GOOD], key=repr)
    assert rows(lm.scan_delimited(spark, str(tmp_path), THINGS)) == want
    assert rows(lm.scan_delimited(spark, [str(tmp_path / "a"), str(tmp_path / "b")], THINGS)) == want


def test_folders_named_after_a_value(spark, tmp_path):
    for number, (line, _) in enumerate(GOOD):
        folder = tmp_path / f"dt={number % 2}" / ("deep" if number == 3 else "")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{number}").write_text(line + "\n")
    all_rows = sorted([row for _, row in GOOD], key=repr)
    assert rows(lm.scan_delimited(spark, str(tmp_path), THINGS, recursive=True)) == all_rows
    (tmp_path / "dt=1" / "deep" / "f3").unlink()
    (tmp_path / "dt=1" / "deep").rmdir()
    assert rows(lm.scan_delimited(spark, str(tmp_path), THINGS)) == sorted([GOOD[i][1] for i in (0, 1, 2, 4)], key=repr)


def test_one_flagged_frame(spark):
    flagged = lm.parse_lines(lines(spark, [line for line, _ in GOOD + BAD]), THINGS, on_error="flag")
    assert flagged.count() == len(GOOD) + len(BAD)
    faulty = flagged.where("__fault IS NOT NULL").select("__fault", "__row_text")
    assert rows(faulty) == sorted([(cause, line) for line, cause in BAD], key=repr)


def test_render(spark):
    df = spark.createDataFrame([row for _, row in GOOD], "a int, b bigint, c double, d string, e timestamp, f binary")
    want = [
        f"-17\t9000000000\t0.125\tgrey heron\t{D}\t00ff10", "0\t\t-2000.0\t\t\t00ff10", "\t\t\t\\N\t\t\\N",
        f"8\t6\t1.5\ttwo  words\t{D}\t", f"2147483647\t-1\t7.0\t{{}}\t{D}\t",
    ]
    assert rows(lm.render(df)) == sorted([(w,) for w in want], key=repr)


def test_render_every_type(spark):
    df = spark.sql(
        "select cast(1 as tinyint), cast(2 as smallint), cast(3.10 as decimal(10,2)), 1e10D, cast(null as decimal(5,2)), cast(null as timestamp)"
    ).toDF(*"abcdef")
    assert rows(lm.render(df, sep="|")) == [("1|2|3.1|1.0E10||",)]


def test_render_checks_the_field_count(spark):
    with pytest.raises(lm.SchemaMismatch):
        lm.render(spark.sql("select 1 a"), target=THINGS)


@pytest.mark.parametrize("sep", ["|", "||", ".", "\\E", "$^", ",", " , ", "a", "é", "\x01"])
def test_separators_are_literal(spark, sep):
    out = lm.parse_lines(lines(spark, [sep.join(["1", "x", "2"])]), "a INTEGER, b STRING, c BIGINT", sep=sep)
    assert rows(out) == [(1, "x", 2)]


@pytest.mark.parametrize("sep", [None, ""])
def test_no_separator_means_tab(spark, sep):
    assert rows(lm.parse_lines(lines(spark, ["1\t2"]), "a INTEGER, b INTEGER", sep=sep)) == [(1, 2)]


@pytest.mark.parametrize("sep", ["|", "\t", "||", " | "])
def test_fields_are_trimmed_of_any_white_space(spark, sep):
    spaces = [c for c in UNICODE_SPACE if c not in sep]
    given = [sep.join([f"{c} 1{c}", "", f" {c}a{c}b{c}", f"{c}"]) for c in spaces]
    out = lm.parse_lines(lines(spark, given), "a INTEGER, b STRING, c STRING, d STRING", sep=sep)
    assert rows(out) == sorted([(1, "", f"a{c}b", "") for c in spaces], key=repr)


def test_control_characters_are_not_white_space(spark):
    accepted, rejects = lm.parse_lines(lines(spark, ["\x017", "\x1f7", "7\x00"]), "a INTEGER", sep="|", on_error="reject")
    assert accepted.count() == 0 and rejects.count() == 3


def test_numbers_at_their_bounds(spark):
    target = "a TINYINT, b SMALLINT, c INTEGER, d BIGINT"
    low = "|".join(str(-(2**b)) for b in (7, 15, 31, 63))
    high = "|".join(str(2**b - 1) for b in (7, 15, 31, 63))
    over = "|".join(str(2**b) for b in (7, 15, 31, 63))
    accepted, rejects = lm.parse_lines(lines(spark, [low, high, over]), target, sep="|", on_error="reject")
    assert rows(accepted) == sorted([tuple(-(2**b) for b in (7, 15, 31, 63)), tuple(2**b - 1 for b in (7, 15, 31, 63))], key=repr)
    assert rejects.head().cause.count(";") == 3


def test_decimals_and_hex(spark):
    out = lm.parse_lines(lines(spark, ["1e3|abc", "-.5|AB", "|", "\\N|\\N"]), "a DECIMAL, b VARBINARY", sep="|")
    got = {(None if a is None else float(a), b) for a, b in rows(out)}
    assert got == {(1000.0, b"\xab"), (-0.5, b"\xab"), (None, b""), (None, None)}


def test_custom_date_format(spark):
    out = lm.parse_lines(lines(spark, ["17.03.2021 18h30"]), "a TIMESTAMP", date_format="dd.MM.yyyy HH'h'mm")
    assert rows(out) == [(datetime(2021, 3, 17, 18, 30),)]


def test_separator_and_newline_do_not_survive(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb"), (2, "c\nd"), (3, "e")], "i int, s string")
    lm.write_delimited(df, str(tmp_path / "out"))
    accepted, rejects = lm.scan_delimited(spark, str(tmp_path / "out"), df.schema, on_error="reject")
    assert rows(accepted) == [(2, "c"), (3, "e")]
    assert rejects.count() == 2


text = st.text(st.characters(blacklist_categories=("Cs", "Cc", "Z")), max_size=8).filter(lambda s: s != "\\N")
row = st.tuples(
    st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)),
    st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
    st.one_of(st.none(), st.floats(allow_nan=False)),
    st.one_of(st.none(), text),
    st.one_of(st.none(), st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)).map(lambda d: d.replace(microsecond=d.microsecond // 1000 * 1000))),
    st.one_of(st.none(), st.binary(max_size=6)),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40))
def test_rendered_rows_read_back(spark, given_rows):
    schema = "fi int, fl bigint, fd double, fs string, ft timestamp, fb binary"
    df = spark.createDataFrame(given_rows, schema)
    back = lm.parse_lines(lm.render(df), THINGS)
    assert rows(back) == rows(df)
