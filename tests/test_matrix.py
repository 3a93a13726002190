import struct
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

import loadmason as lm
from loadmason.functions.coerce import LOOSE, STRICT, is_compatible
from loadmason.functions.types import STORED_AS

SPARK = {"byte": "tinyint", "short": "smallint", "int": "int", "long": "bigint", "double": "double",
         "decimal": "decimal(38,12)", "string": "string", "bytes": "binary", "date": "timestamp"}


def convert(spark, source_type, into, values, **options):
    """Value and refusal for each input."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {source_type}")
    out = lm.convert_columns(df, [("v", F.col("x"), into)], keep=["i"], **options)
    if into == "TIMESTAMP":
        out = out.withColumn("v", F.unix_millis("v"))
    found = {r.i: (bytes(r.v) if isinstance(r.v, bytearray) else r.v, r.v_refused) for r in out.collect()}
    return [found[i] for i in range(len(values))]


def values(spark, source_type, into, given, **options):
    out = convert(spark, source_type, into, given, **options)
    assert not any(refused for _, refused in out)
    return [value for value, _ in out]


def test_size_of_the_matrix():
    assert sum(len(t) for t in STRICT.values()) == 42
    assert sum(len(t) for t in STRICT.values()) + sum(len(t) for t in LOOSE.values()) == 68
    never = [(k, t) for k in STRICT for t in STORED_AS if not is_compatible(k, t, strictly=False)]
    assert len(never) == 13


@pytest.mark.parametrize("kind", STRICT)
def test_null_goes_to_null_everywhere(spark, kind):
    wanted = sorted(STRICT[kind] | LOOSE[kind])
    df = spark.createDataFrame([(None,)], f"x {SPARK[kind]}")
    out = lm.convert_columns(df, [(into, F.col("x"), into) for into in wanted])
    assert out.select(*wanted).head() == (None,) * len(wanted)
    assert not any(out.select(*[f"{into}_refused" for into in wanted]).head())


@pytest.mark.parametrize("kind", STRICT)
def test_strict_mode_refuses_loose_and_never_pairs(spark, kind):
    df = spark.createDataFrame([], f"x {SPARK[kind]}")
    for into in set(STORED_AS) - STRICT[kind]:
        with pytest.raises(lm.SchemaMismatch):
            lm.check(df.schema, [("x", into)])
        if into in LOOSE[kind]:
            lm.check(df.schema, [("x", into)], mode="loose")
        else:
            with pytest.raises(lm.SchemaMismatch):
                lm.check(df.schema, [("x", into)], mode="loose")


MARCH = datetime(2021, 3, 17, 18, 30, 9)
MARCH_MS = 1616005809000

VECTORS = {
    "tinyint": [(into, v, want) for v in (-77, 0, 33) for into, want in (
        ("TINYINT", v), ("SMALLINT", v), ("INTEGER", v), ("BIGINT", v), ("FLOAT", float(v)), ("DECIMAL", Decimal(v)),
        ("STRING", str(v)), ("VARBINARY", v.to_bytes(1, "big", signed=True)))],
    "smallint": [(into, v, want) for v in (-30001, 1024) for into, want in (
        ("SMALLINT", v), ("INTEGER", v), ("BIGINT", v), ("FLOAT", float(v)), ("DECIMAL", Decimal(v)), ("STRING", str(v)),
        ("VARBINARY", v.to_bytes(2, "big", signed=True)))],
    "int": [(into, v, want) for v in (-2000000001, 65537) for into, want in (
        ("INTEGER", v), ("BIGINT", v), ("FLOAT", float(v)), ("DECIMAL", Decimal(v)), ("STRING", str(v)),
        ("VARBINARY", v.to_bytes(4, "big", signed=True)))],
    "bigint": [(into, v, want) for v in (-(10**12), MARCH_MS + 7) for into, want in (
        ("BIGINT", v), ("FLOAT", float(v)), ("DECIMAL", Decimal(v)), ("STRING", str(v)), ("TIMESTAMP", v),
        ("VARBINARY", v.to_bytes(8, "big", signed=True)))],
    "double": [
        ("FLOAT", -6.25e-3, -6.25e-3), ("DECIMAL", 4096.0625, Decimal("4096.0625")), ("STRING", 987654.5, "987654.5"),
        ("STRING", 2.5e7, "2.5E7"), ("VARBINARY", 987654.5, struct.pack(">d", 987654.5)), ("VARBINARY", -0.0, b"\x80" + b"\0" * 7),
        ("TIMESTAMP", 86400.25, 86400250), ("TIMESTAMP", -1.5, -1500),
    ],
    "timestamp": [
        ("BIGINT", MARCH, MARCH_MS), ("DECIMAL", MARCH.replace(microsecond=77000), Decimal(MARCH_MS + 77)),
        ("STRING", MARCH.replace(microsecond=5000), "2021-03-17 18:30:09.005"), ("VARBINARY", MARCH, MARCH_MS.to_bytes(8, "big")),
        ("FLOAT", MARCH.replace(microsecond=500999), MARCH_MS / 1000 + 0.5),
        ("TIMESTAMP", MARCH.replace(microsecond=123456), MARCH_MS + 123),
    ],
    "decimal(38,12)": [
        ("DECIMAL", Decimal("-987654321098765432109876.5"), Decimal("-987654321098765432109876.5")),
        ("STRING", Decimal("31415926535897932384.626"), "31415926535897932384.626"),
        ("STRING", Decimal("4200"), "4200"), ("STRING", Decimal("0"), "0"), ("STRING", Decimal("-0.25"), "-0.25"),
        ("FLOAT", Decimal("2.75"), 2.75), ("TIMESTAMP", Decimal(MARCH_MS), MARCH_MS),
        ("VARBINARY", Decimal("3"), (3 * 10**12).to_bytes(16, "big")),
        ("VARBINARY", Decimal("-0.000000000001"), b"\xff" * 16),
        ("VARBINARY", Decimal("-31415926535897932384.626"),
         (-31415926535897932384626 * 10**9).to_bytes(16, "big", signed=True)),
    ],
    "string": [
        ("STRING", "heron", "heron"), ("STRING", "", ""), ("STRING", "\\N", None), ("STRING", " \\N", " \\N"),
        ("VARBINARY", "ñu", "ñu".encode()), ("VARBINARY", "\\N", None),
    ],
    "binary": [
        ("VARBINARY", b"\x07\xfe", b"\x07\xfe"), ("STRING", "ñu".encode(), "ñu"), ("STRING", b"u\xfen", "u\ufffdn"),
    ],
    "boolean": [("TINYINT", True, 1), ("TINYINT", False, 0), ("STRING", True, "1")],
    "float": [("FLOAT", 0.375, 0.375), ("FLOAT", 2.200000047683716, 2.200000047683716)],
}


@pytest.mark.parametrize("source", VECTORS)
def test_golden_vectors(spark, source):
    cases = VECTORS[source]
    schema = ", ".join(f"x{i} {source}" for i in range(len(cases)))
    df = spark.createDataFrame([tuple(given for _, given, _ in cases)], schema)
    out = lm.convert_columns(df, [(f"v{i}", F.col(f"x{i}"), into) for i, (into, _, _) in enumerate(cases)])
    shown = [F.unix_millis(f"v{i}") if into == "TIMESTAMP" else F.col(f"v{i}") for i, (into, _, _) in enumerate(cases)]
    got = [bytes(v) if isinstance(v, bytearray) else v for v in out.select(*shown).head()]
    assert got == [want for _, _, want in cases]
    assert not any(out.select(*[f"v{i}_refused" for i in range(len(cases))]).head())


BOUNDS = {"TINYINT": 7, "SMALLINT": 15, "INTEGER": 31}


@pytest.mark.parametrize("source,into", [
    ("smallint", "TINYINT"), ("int", "TINYINT"), ("int", "SMALLINT"), ("bigint", "TINYINT"), ("bigint", "SMALLINT"), ("bigint", "INTEGER"),
])
def test_whole_number_narrowing_leaves_out_the_lowest(spark, source, into):
    low, high = -(2 ** BOUNDS[into]), 2 ** BOUNDS[into] - 1
    got = convert(spark, source, into, [low - 1, low, low + 1, 0, high, high + 1])
    assert got == [(None, True), (None, True), (low + 1, False), (0, False), (high, False), (None, True)]


def test_identity_keeps_the_lowest(spark):
    assert values(spark, "bigint", "BIGINT", [-(2**63)]) == [-(2**63)]
    assert values(spark, "tinyint", "TINYINT", [-128]) == [-128]


@pytest.mark.parametrize("into,bits", BOUNDS.items())
def test_double_range_is_tested_before_the_fraction_goes(spark, into, bits):
    low, high = float(-(2**bits)), float(2**bits - 1)
    got = convert(spark, "double", into, [low, low + 0.5, high, high + 0.5, 2.9, -2.9, float("nan"), float("inf")])
    assert got == [(None, True), (int(low + 0.5), False), (int(high), False), (None, True), (2, False), (-2, False), (None, True), (None, True)]


def test_double_to_bigint_edges(spark):
    got = convert(spark, "double", "BIGINT", [-(2.0**63), 2.0**63, 1e19, -1.5])
    assert got == [(None, True), (2**63 - 1, False), (None, True), (-1, False)]


@pytest.mark.parametrize("into,bits", [*BOUNDS.items(), ("BIGINT", 63)])
def test_decimal_narrowing_is_exact_and_keeps_both_bounds(spark, into, bits):
    low, high = -(2**bits), 2**bits - 1
    given = [Decimal(low), Decimal(high), Decimal(low - 1), Decimal(high + 1), Decimal("1.5"), Decimal("1.000000000001")]
    assert convert(spark, "decimal(38,12)", into, given) == [
        (low, False), (high, False), (None, True), (None, True), (None, True), (None, True)]


def test_decimal_with_few_integer_digits(spark):
    assert convert(spark, "decimal(38,30)", "INTEGER", [Decimal(7), Decimal("7." + "0" * 29 + "1")]) == [(7, False), (None, True)]


def test_decimal_too_wide_for_the_target(spark):
    assert convert(spark, "decimal(38,0)", "DECIMAL", [Decimal(10**26 - 1), Decimal(10**26)]) == [
        (Decimal(10**26 - 1), False), (None, True)]


@pytest.mark.parametrize("into", ["TINYINT", "SMALLINT", "INTEGER", "BIGINT"])
def test_strings_to_whole_numbers(spark, into):
    bits = {**BOUNDS, "BIGINT": 63}[into]
    given = ["", "   ", "\\N", " \\N\t", "7", "+7", "-7", " 5 ", "5\n", "1.0", "1e2", "abc", str(-(2**bits)), str(2**bits), "\x015"]
    assert convert(spark, "string", into, given) == [
        (None, False), (None, False), (None, False), (None, False), (7, False), (7, False), (-7, False),
        (None, True), (None, True), (None, True), (None, True), (None, True), (-(2**bits), False), (None, True), (None, True)]


def test_strings_to_doubles(spark):
    given = [" 1e3 ", "1d", "0x1p3", "Infinity", "-Infinity", "inf", "infinity", "nan", "x", "", "\\N", "1e999", "1.5f"]
    got = convert(spark, "string", "FLOAT", given)
    inf = float("inf")
    assert got == [(1000.0, False), (1.0, False), (8.0, False), (inf, False), (-inf, False), (None, True), (None, True),
                   (None, True), (None, True), (None, False), (None, False), (inf, False), (1.5, False)]
    (nan, refused), = convert(spark, "string", "FLOAT", ["NaN"])
    assert nan != nan and not refused


def test_strings_to_decimals(spark):
    given = [" 1.5 ", "1e3", ".5", "5.", "1.0000000000005", "1" * 27, "x", "NaN", "  ", "1 2"]
    assert convert(spark, "string", "DECIMAL", given) == [
        (Decimal("1.5"), False), (Decimal(1000), False), (Decimal("0.5"), False), (Decimal(5), False),
        (Decimal("1.000000000001"), False), (None, True), (None, True), (None, True), (None, False), (None, True)]


def test_strings_to_timestamps(spark):
    given = ["2021-03-17 18:30:09.045", "2021-03-17 18:30:09.5", "2021-13-17 18:30:09.000", "2021-03-17 18:30:09.000x",
             "2021-03-17 18:30:09", " 2021-03-17 18:30:09.000", "", " \\N "]
    assert convert(spark, "string", "TIMESTAMP", given) == [
        (MARCH_MS + 45, False), (MARCH_MS + 500, False), (None, True), (None, True), (None, True), (None, True), (None, False), (None, False)]
    assert convert(spark, "string", "TIMESTAMP", ["17.03.2021", "2021"], date_format="dd.MM.yyyy") == [
        (1615939200000, False), (None, True)]


def test_the_default_pattern_reads_what_the_pattern_reads(spark):
    given = ["2021-03-17 01:00:05.1", "2021-03-17 24:00:05.100", "2021-3-7 01:00:05.100", "1500-02-29 00:00:00.000", "0001-01-01 00:00:00.000",
             "2021-03-17T01:00:05.100", "2021-03-17 01:00:05.1234", "2021-03-17 01:00:60.000", "12021-03-17 01:00:05.100"]
    df = spark.createDataFrame([(v,) for v in given], "x string")
    from loadmason.functions.parsing import parse_timestamp
    from loadmason.functions.types import DEFAULT_DATE_FORMAT

    same = df.filter(~parse_timestamp(F.col("x"), DEFAULT_DATE_FORMAT).eqNullSafe(F.try_to_timestamp("x", F.lit(DEFAULT_DATE_FORMAT))))
    assert same.count() == 0


def test_numbers_no_timestamp_can_hold(spark):
    assert convert(spark, "bigint", "TIMESTAMP", [2**63 - 1, -(2**63)]) == [(None, True)] * 2
    assert convert(spark, "double", "TIMESTAMP", [1e300, float("nan")]) == [(None, True)] * 2
    assert convert(spark, "decimal(38,12)", "TIMESTAMP", [Decimal("0.5"), Decimal(10**25)]) == [(None, True)] * 2


def test_double_to_decimal(spark):
    assert convert(spark, "double", "DECIMAL", [1e30, float("nan"), float("inf"), 0.1]) == [
        (None, True), (None, True), (None, True), (Decimal("0.1"), False)]


def test_exact_decimals_are_opt_in(spark):
    df = spark.createDataFrame([(24681357.001,), (float("nan"),), (None,), (1e30,)], "x double")
    accepted, rejects = lm.coerce(df, "x DECIMAL", on_error="reject", exact_decimals=True)
    assert rows(accepted) == [(Decimal("24681357.000999998301"),), (None,)]
    assert rejects.count() == 2


def test_zone_less_timestamps_and_dates(spark):
    df = spark.sql("select timestamp_ntz'2021-03-17 01:00:05.123456' a, date'2021-09-12' b")
    out = lm.coerce(df, "a BIGINT, b BIGINT")
    assert rows(out) == [(1615942805123, 1631404800000)]


def test_custom_pattern_for_dates(spark):
    df = spark.sql("select timestamp'2021-03-17 01:00:05' a")
    assert rows(lm.coerce(df, "a STRING", date_format="yyyy/MM/dd HH")) == [("2021/03/17 01",)]
    assert rows(lm.coerce(df, "a STRING", date_format="  ")) == [("2021-03-17 01:00:05.000",)]


@pytest.mark.parametrize("ddl", ["x array<int>", "x map<int,string>", "x struct<a:int>", "x interval day to second"])
def test_other_sources_are_refused(spark, ddl):
    with pytest.raises(lm.SchemaMismatch, match="not supported"):
        lm.coerce(spark.createDataFrame([], ddl), "x STRING")


def test_ten_field_kinds_and_a_null_row(spark):
    source = "a int, b bigint, c float, d double, e boolean, f decimal(10,0), g decimal(38,0), h string, i binary, j timestamp"
    target = "a INTEGER, b BIGINT, c FLOAT, d FLOAT, e TINYINT, f DECIMAL, g DECIMAL, h STRING, i VARBINARY, j TIMESTAMP"
    at = datetime(1970, 1, 1, 0, 0, 0, 10000)
    df = spark.createDataFrame([(1, 2, 3.0, 4.0, True, Decimal(6), Decimal(7), "8", b"9", at), (None,) * 10], source)
    assert rows(lm.coerce(df, target)) == sorted(
        [(1, 2, 3.0, 4.0, 1, Decimal(6), Decimal(7), "8", b"9", at), (None,) * 10], key=repr)


def test_failing_mode_names_the_column_and_the_value(spark):
    df = spark.createDataFrame([(5, "12x")], "i int, x string")
    with pytest.raises(Exception, match="n: string does not fit INTEGER: 12x"):
        lm.coerce(df, "i INTEGER, n INTEGER", mode="loose").collect()


def test_rejects_carry_every_cause_and_the_row(spark):
    df = spark.createDataFrame([("x", 300), ("1", 3)], "a string, b int")
    accepted, rejects = lm.coerce(df, "a INTEGER, b TINYINT", mode="loose", on_error="reject")
    assert rows(accepted) == [(1, 3)]
    assert rows(rejects) == [("a: string does not fit INTEGER; b: int does not fit TINYINT", "x|300")]


def test_columns_match_by_position_not_name(spark):
    df = spark.createDataFrame([(1, 2)], "b int, b int")
    assert rows(lm.coerce(df, "a INTEGER, b BIGINT").select("a", "b")) == [(1, 2)]
