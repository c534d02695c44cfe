"""Every registered plan against its SQL on the smallest given tables."""

import os

import pytest

from tests.oracle import compare, connect
from tierwork.plans import ORACLE, QUERIES

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# the fixed dates and values of these leave nothing at this scale, on both sides
MAY_BE_EMPTY = {"dq_orphan_keys"}


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plan_equals_sql(spark, con, name):
    msg = compare(spark, con, ROOT, QUERIES[name], ORACLE[name])
    assert msg == "" or (msg == "no rows" and name in MAY_BE_EMPTY)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_plan_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["n_name", "month", "revenue_eur", "n_lines", "n_credit_lines", "n_first_lines"]
