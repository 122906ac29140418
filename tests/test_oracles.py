"""Every registered query next to its SQL oracle on the smallest tables."""

import pytest

from quern.plans import ORACLES, QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    n, problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert not problem, problem
    assert n > 0


def test_entry_runs():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "web_math_to_chat" in e.queries()
