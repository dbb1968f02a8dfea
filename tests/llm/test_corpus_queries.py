"""The registered corpus queries against SQL, on the smallest tables and on tables of odd rows."""

import pytest
from corpus_tables import duck

from pricefield.llm.catalog import ORACLES, QUERIES
from tools.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(ORACLES[name]).fetchdf()) == []


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op7_jaccard", "op11_collocations", "op13_minmax"}))
def test_query_matches_sql_on_odd_rows(spark, odd, name):
    got = QUERIES[name](spark, odd).toPandas()
    assert differences(got, duck(odd).execute(ORACLES[name]).fetchdf()) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_takes_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0
