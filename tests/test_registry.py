"""Driver contract: entry smoke, register consistency, oracle agreement on sf0.001."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from oracle_check import compare, duck
from tastegraph.plans import registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["productId", "rank", "otherId", "score"]


def test_register_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle_sf0001(spark, name):
    res = compare(spark, SF_SMALL, name, duck(SF_SMALL))
    assert res["status"] == "OK", res
