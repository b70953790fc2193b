"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest driver tables so the suite stays quick."""

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as E  # noqa: E402
from featuremart.plans import QUERIES  # noqa: E402
from tools.oracle_check import compare, duck_connect  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    assert missing == [], f"queries without oracle SQL: {missing}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_key" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert r["status"] == "OK", r
    assert not r.get("types"), r
