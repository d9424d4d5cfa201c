"""Each query against its SQL in DuckDB: columns, types, row count, values."""

import os

import pytest

import __spark_entry__ as contract
from tallybook.queries import QUERIES
from tests.oracle import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no tables in {FOLDER}")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(contract.oracle_sql())))
def test_same_as_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(contract.oracle_sql())))
def test_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_estimate_is_near(spark, con):
    exact = dict(con.execute("SELECT lang, count(DISTINCT text) FROM documents GROUP BY lang").fetchall())
    for row in contract.queries()["distinct_estimate"](spark, FOLDER).collect():
        assert abs(row.n_oids_estimate - exact[row.lang]) <= 0.15 * exact[row.lang]


def test_approximate_percentiles_are_near(spark, con):
    sql = """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5), quantile_cont(l_extendedprice, 0.95)
             FROM lineitem GROUP BY 1"""
    exact = {flag: (p50, p95) for flag, p50, p95 in con.execute(sql).fetchall()}
    for row in contract.queries()["size_stats_approximate"](spark, FOLDER).collect():
        assert row.p50 == pytest.approx(exact[row.l_returnflag][0], rel=0.01)
        assert row.p95 == pytest.approx(exact[row.l_returnflag][1], rel=0.01)


def test_entry_smoke(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and all(r.n > 1 for r in rows)
