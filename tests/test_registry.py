"""Every registered query against its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from pricefield.plans.catalog import ORACLES, QUERIES
from tools.compare import connect, differences

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "ensemble_stacking", "holt_winters", "ar_select", "ar_forecast", "trend_seasonal_fit", "forecast_components",
    "window_regressor", "window_regressor_huber", "window_regressor_gbt", "batch_score", "qq_points", "hybrid_flow",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_queries_without_sql_are_the_known_ones():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_imports_without_the_corpus_part():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "from pricefield.plans.catalog import QUERIES; assert set(e.queries()) == set(QUERIES)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).fetchdf()
    assert differences(got, want) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
