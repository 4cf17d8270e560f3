"""Every query of the subpackage that has an SQL twin equals it on the smallest tables."""

import pytest

from tallyworks.llm.oracles import ORACLES
from tallyworks.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.oracle_check import compare, oracle_connection

FITTED = {
    "op3_language_id", "op4_simhash", "op8_nearest_neighbours", "op9_quality_classifier",
    "op11_best_fit_packing", "pipeline",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), oracle_connection(SMALL), ORACLES[name]) is None


def test_what_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == FITTED


def test_entry_registers_them(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
