"""Every registered query against its SQL in DuckDB, and the fixture numbers."""

import os

import pytest

import __spark_entry__ as contract
from shoptrail.verify import registry
from shoptrail.verify.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    own = set(registry.REGISTRY)
    assert own <= set(contract.queries())
    assert own - set(contract.oracle_sql()) == set()


def test_entry(spark):
    assert contract.entry(spark).count() == 30


@pytest.mark.parametrize("name", sorted(registry.REGISTRY))
def test_query_equals_sql(spark, duck, name):
    query, sql = registry.REGISTRY[name]
    got = query(spark, SF_DIR).toArrow()
    assert got.num_rows > 0
    if sql is not None:
        assert difference(got, duck.sql(sql).to_arrow_table()) is None


EXPECTED = {
    "/root/testdata/sf0.001": {"silver": 704, "sessions": 354, "purchases": 175, "revenue": 9039.55},
    "/root/testdata/sf0.01": {"silver": 7075, "sessions": 3531, "purchases": 1761, "revenue": 82267.40},
    "/root/testdata/sf0.1": {"silver": 71180, "sessions": 35779, "purchases": 17849, "revenue": 872224.21},
}


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED))
def test_known_numbers(spark, sf_dir):
    facts = registry.fct_sessions(spark, sf_dir)
    row = facts.selectExpr(
        "sum(event_count) AS silver", "count(*) AS sessions", "sum(purchase_count) AS purchases",
        "round(sum(session_revenue), 2) AS revenue",
    ).first()
    assert row.asDict() == EXPECTED[sf_dir]
