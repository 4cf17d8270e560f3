import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyworks.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        **{
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tallyworks.bindings import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def frame(spark):
    """Make a frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def column_of():
    """Values of the only, or the named, column, in order."""

    def values(df, name=None):
        name = name or df.columns[-1]
        return [r[name] for r in df.collect()]

    return values
