import uuid

import pytest

import loadmason as lm
from loadmason.session import local_session, new_path


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("wh")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    return local_session("tests", cores="4", **settings)


@pytest.fixture
def table(spark):
    """Makes empty tables with fresh names."""

    def make(target, **options):
        name = f"t_{uuid.uuid4().hex}"
        lm.create_table(spark, name, target, location=new_path(spark, name), **options)
        return name

    return make


def rows(df):
    """Rows in a comparable form, in any order."""
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in row) for row in df.collect()), key=repr)
