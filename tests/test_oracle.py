"""Every registered query against its DuckDB oracle on sf0.01 (the driver's
correctness gate), plus plan checks on the same queries."""

import pytest

from __spark_entry__ import entry
from bourse.plans.oracle import ORACLE
from bourse.plans.registry import QUERIES
from tests.conftest import SF001
from tools.check_oracle import compare, duck



@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


def _jvm_only(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    _jvm_only(df)
    want = con.sql(ORACLE[name]).df()
    assert compare(df.toPandas(), want) == "OK"


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["year", "max_relative_increase_ticker", "investment_return_by_end_of_year",
                          "max_CAGR_ticker_jan_june", "max_decrease_by_week_ticker",
                          "max_decrease_by_week_weeknum"]
    assert df.count() == 7


def test_fixture_values_sf001(spark):
    """FIXTURES.md values for the 1997 ranges on sf0.01."""
    a = QUERIES["max_relative_increase_1997"](spark, SF001).first()
    assert (a.ticker, a.first_close, a.last_close) == ("NATION_0", 3138.66, 465719.62)
    assert a.net_change == 147.38167243345887
    c = QUERIES["max_cagr"](spark, SF001).first()
    assert (c.ticker, round(c.CAGR, 6)) == ("NATION_8", 1541.129981)
    s = QUERIES["consolidate"](spark, SF001).first()
    assert s.investment_return_by_end_of_year == pytest.approx(7111435.70, abs=0.005)
    assert (s.max_decrease_by_week_ticker, s.max_decrease_by_week_weeknum) == ("NATION_0", "1997-4")
