"""Plan shapes that decide whether a query holds at scale."""

import re

import pytest

import __spark_entry__ as entry
from pricefield.operators import cleaning, daily
from pricefield.sources.views import prices_orders

SF = "/root/testdata/sf0.001"
ROW_GRAIN = [
    "dedup_quotes", "daily_mean", "daily_median", "daily_weighted", "filter_category", "join_group_stats", "semi_topk",
    "log_return", "panel_rolling", "global_index", "ffill_bfill_rows", "sequence_windows", "sequence_windows_global",
    "information_coefficient", "error_ecdf", "boxplot_stats", "cv_folds", "ensemble_weighted",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ROW_GRAIN)
def test_no_all_pairs_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["global_index", "sequence_windows_global", "ffill_bfill_rows", "panel_rolling", "log_return"])
def test_rows_never_meet_in_one_task(spark, name):
    """Only tables of counts (after an aggregate) may go to a single partition."""
    lines = plan(entry.queries()[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1: i + 5])
            assert "HashAggregate" in below or "ObjectHashAggregate" in below or "SortAggregate" in below, below


def test_scan_reads_only_needed_columns(spark):
    text = plan(daily.daily_mean(prices_orders(spark, SF), ["commodity"]))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_totalprice", "o_orderdate", "o_orderpriority"}


def test_fence_bounds_reach_the_scan(spark):
    df = cleaning.trim_quantiles(prices_orders(spark, SF), 0.01, 0.99)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_totalprice" in text and "LessThanOrEqual(o_totalprice" in text


def test_features_of_one_pass_share_one_sort(spark):
    text = plan(entry.queries()["lag_features"](spark, SF))
    assert text.count("Exchange hashpartitioning(commodity") == 2  # daily mean, then the series


def test_group_means_are_combined_before_the_shuffle(spark):
    text = plan(daily.daily_mean_count(prices_orders(spark, SF), ["commodity"]))
    assert "partial_avg" in text and "partial_count" in text
