"""Every registered query against its DuckDB oracle at sf0.01: equal row
counts, column names, types and values (doubles bit for bit)."""

import pytest

import __spark_entry__ as entry
from cadence.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF01
from tests.harness import compare, duck_connect

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF01)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(entry.queries()[name](spark, SF01), con, entry.oracle_sql()[name])
    assert res["ok"], res


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_with_shuffle_joins(spark, con, no_broadcast, name):
    """The plans large inputs get (no broadcast joins): same results."""
    res = compare(entry.queries()[name](spark, SF01), con, entry.oracle_sql()[name])
    assert res["ok"], res
