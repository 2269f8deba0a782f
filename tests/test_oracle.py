"""Every registered query against its SQL oracle on the smallest test tables."""

from __future__ import annotations

import os

import pytest

from workload.compare import connect, difference
from workload.oracle import FINAL
from workload.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, oracle, name):
    assert difference(spark, oracle, FOLDER, name) is None


def test_every_oracle_has_a_query():
    assert set(QUERIES) == set(FINAL)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns[0] == "sales_date" and len(flagship.columns) == 13


def test_totals_are_conserved(spark):
    """Orders with a date all reach the daily summary; shares of returns add up to one."""
    from pyspark.sql import functions as F

    from workload.queries import Model

    model = Model(spark, FOLDER)
    dated = model.fact_orders().filter(F.col("order_purchase_date").isNotNull()).count()
    assert model.daily_sales_summary().agg(F.sum("total_orders")).first()[0] == dated
    share = model.return_rate_by_reason().agg(F.sum("pct_of_all_returns")).first()[0]
    assert abs(float(share) - 1) < 0.001
