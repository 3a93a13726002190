import pytest
from pyspark.sql import types as T

import loadmason as lm

THINGS = "fi INTEGER, fl BIGINT, fd FLOAT, fs STRING, ft TIMESTAMP, fb VARBINARY"


def schema(types):
    return T.StructType.fromDDL(", ".join(f"c{i} {t}" for i, t in enumerate(types)))


def test_exact_match(spark):
    lm.check(schema(["int", "bigint", "double", "string", "timestamp", "binary"]), THINGS, mode="exact")


OWN = ["int", "bigint", "double", "string", "timestamp", "binary"]


@pytest.mark.parametrize("types", [
    OWN[:3], [*OWN, "int"], [*OWN[1::-1], *OWN[2:]], ["smallint", *OWN[1:]], [*OWN[:3], "binary", *OWN[4:]],
    [*OWN[:4], "date", OWN[5]], [*OWN[:5], "array<tinyint>"],
])
def test_exact_mismatches(spark, types):
    with pytest.raises(lm.SchemaMismatch):
        lm.check(schema(types), THINGS, mode="exact")


def test_exact_decimal_is_26_12(spark):
    lm.check(schema(["decimal(26,12)"]), "a DECIMAL", mode="exact")
    with pytest.raises(lm.SchemaMismatch):
        lm.check(schema(["decimal(38,12)"]), "a DECIMAL", mode="exact")


def test_strict_allows_what_exact_does_not(spark):
    lm.check(schema(["int"]), "a BIGINT")
    with pytest.raises(lm.SchemaMismatch):
        lm.check(schema(["int"]), "a BIGINT", mode="exact")


def test_every_problem_is_named(spark):
    with pytest.raises(lm.SchemaMismatch, match="c0.*c1"):
        lm.check(schema(["bigint", "array<int>"]), "a INTEGER, b STRING")


def test_column_counts_must_match(spark):
    with pytest.raises(lm.SchemaMismatch, match="expected 2, actual 1"):
        lm.check(schema(["int"]), "a INTEGER, b INTEGER")


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        lm.check(schema(["int"]), "a INTEGER", mode="lenient")


@pytest.mark.parametrize("name", [None, "", "  ", "no_such_table"])
def test_target_must_be_named_and_exist(spark, name):
    with pytest.raises(lm.TargetMissing):
        lm.check_target(spark, name)


def test_target_of_a_table(spark, table):
    assert lm.check_target(spark, table(THINGS)).types == lm.Target.of(THINGS).types


def test_altered_table_is_seen(spark, table):
    name = table("a INTEGER")
    assert len(lm.check_target(spark, name)) == 1
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (b STRING)")
    assert lm.check_target(spark, name).types == ["INTEGER", "STRING"]


def test_target_from_a_columns_listing(spark):
    listing = spark.createDataFrame(
        [("THINGS", "b", "BIGINT", 2), ("other", "z", "INTEGER", 1), ("things", "a", "INTEGER", 1), ("Things", "c", "VARBINARY", 10)],
        "table_name string, column_name string, type_name string, ordinal_position int",
    )
    target = lm.target_from_columns(listing, "tHINGS")
    assert target.names == ["a", "b", "c"] and target.types == ["INTEGER", "BIGINT", "VARBINARY"]
    with pytest.raises(lm.TargetMissing, match="does not exist"):
        lm.target_from_columns(listing, "nothing")
