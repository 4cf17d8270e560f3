"""Every query with an SQL twin agrees with it, here on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tests.oracle_check import compare, oracle_connection

SLOW_MODELS = {"score_ridge", "score_forest"}
#: The queries of the library itself; those of the training-data subpackage have tests of their own.
OWN = {name for name, build in queries().items() if ".llm." not in build.__module__}


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", sorted(OWN & set(oracle_sql())))
def test_query_equals_sql(spark, connection, name):
    problem = compare(queries()[name](spark, SMALL), connection, oracle_sql()[name])
    assert problem is None, problem


def test_every_query_has_sql_except_the_models():
    assert OWN - set(oracle_sql()) == SLOW_MODELS
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["type", "title", "total_watch_time"]
    assert result.count() >= 10
