import pytest
from pyspark.sql import types as T

from loadmason import SchemaMismatch, Target

THINGS = "fi INTEGER, fl BIGINT, fd FLOAT, fs STRING, ft TIMESTAMP, fb VARBINARY"


def test_signature():
    # a fixed value: signatures already stored elsewhere have to match
    assert Target.of(THINGS).signature == "08133dba-9305-9f91-36fd-46970bbc51e4"


def test_signature_ignores_names_and_sees_order():
    assert Target.of("a INTEGER, b BIGINT").signature == Target.of("x INTEGER, y BIGINT").signature
    assert Target.of("a INTEGER, b BIGINT").signature != Target.of("a BIGINT, b INTEGER").signature


def test_target_from_spark_schema():
    target = Target.of(T.StructType.fromDDL("a tinyint, b smallint, c int, d bigint, e double, f timestamp, g string, h binary, i decimal(20,3)"))
    assert target.types == ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "FLOAT", "TIMESTAMP", "STRING", "VARBINARY", "DECIMAL"]
    assert target.columns[-1].spark_type == T.DecimalType(20, 3)


@pytest.mark.parametrize("ddl", ["a float", "a boolean", "a date", "a array<int>", "a map<int,string>", "a struct<b:int>"])
def test_types_outside_the_nine(ddl):
    with pytest.raises(SchemaMismatch):
        Target.of(T.StructType.fromDDL(ddl))


@pytest.mark.parametrize("spec", ["a INT32", "a", "a INTEGER NOT"])
def test_bad_target_text(spec):
    with pytest.raises(SchemaMismatch):
        Target.of(spec)
