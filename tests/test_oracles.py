"""Every registered query with an oracle gives the oracle's rows; the others give rows."""

import pytest
from compare import difference, oracle_connection
from conftest import SF_DIR

from evidex.plans.oracles import ORACLES
from evidex.plans.registered import QUERIES

# Checked in their own way elsewhere in the tests.
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_only_known_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) <= ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
