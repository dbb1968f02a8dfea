"""The modular flow from typed quotes to compared models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricefield.plans.flows import FlowConfig, fit_and_score, hybrid_flow, prepare_windows
from pricefield.sources.views import prices_events, prices_orders

SF = "/root/testdata/sf0.001"


def test_modular_flow(spark):
    config = FlowConfig(length=5, lags=[1, 2, 3], windows=[3, 5], n_features=6, external=False)
    done = prepare_windows(prices_orders(spark, SF), ["commodity"], "price", config)
    assert len(done.features) == 7 and done.features[0] == "price"
    counts = {r["split"]: r["count"] for r in done.windows.groupBy("split").count().collect()}
    total = sum(counts.values())
    assert abs(counts["train"] / total - 0.70) < 0.01 and abs(counts["test"] / total - 0.15) < 0.01
    models, table = fit_and_score(done, ["ridge"])
    row = table.first()
    assert set(models) == {"ridge"} and row["model"] == "ridge"
    # prices, not scaled values, and better than predicting the mean
    assert row["rmse"] > 100 and row["r2"] > 0


def test_short_series_make_no_window(spark):
    config = FlowConfig(length=60, lags=[1], windows=[3], n_features=2, external=False)
    done = prepare_windows(prices_events(spark, SF), ["commodity"], "price", config)
    assert done.windows.count() == 0


def test_hybrid_flow_equals_least_squares(spark):
    rng = np.random.default_rng(8)
    y = rng.normal(50, 10, 400)
    made = {"a": y + rng.normal(0, 3, 400), "b": 0.5 * y + rng.normal(0, 2, 400) + 25, "c": rng.normal(50, 10, 400)}
    rows = [(m, i, float(y[i]), float(p[i])) for m, p in made.items() for i in range(400)]
    table = spark.createDataFrame(rows, "model string, idx long, y_true double, y_pred double")
    results, stacked = hybrid_flow(table, ["idx"], F.col("idx") < 300, 2)
    x = np.stack([np.ones(400), made["a"], made["b"]], 1)
    coef = np.linalg.lstsq(x[:300], y[:300], rcond=None)[0]
    got = stacked.orderBy("idx").toPandas()
    assert got["idx"].tolist() == list(range(300, 400))
    np.testing.assert_allclose(got["y_pred"], x[300:] @ coef, atol=0.02)
    ranked = results.toPandas()
    assert set(ranked["model"]) == {"a", "b", "c", "hybrid"} and ranked["model"].iloc[0] == "hybrid"
    assert ranked["r2"].is_monotonic_decreasing
    rmse = np.sqrt(((y[300:] - got["y_pred"]) ** 2).mean())
    assert ranked["rmse"].iloc[0] == pytest.approx(rmse)
