"""Forecasters, metrics and ensembles against plain NumPy."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricefield.functions.arithmetic import correlation_pvalue
from pricefield.operators import ensemble, forecasters, metrics, profile, selection


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    start = dt.date(2018, 1, 1)
    parts = []
    for name, n in (("a", 420), ("b", 260), ("tiny", 9)):
        t = np.arange(n)
        y = 50 + 0.05 * t + 4 * np.sin(2 * np.pi * t / 7) + 3 * np.sin(2 * np.pi * t / 365.25) + rng.normal(0, 0.5, n)
        parts.append(pd.DataFrame({"k": name, "date": [start + dt.timedelta(days=int(i)) for i in t], "price": y}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(4)


def plain_smoothing(y, a, b, g, m, seasonal, trend):
    """The textbook recursion, one parameter set, scalars only."""
    if seasonal:
        level = y[:m].mean()
        slope = (y[m:2 * m].mean() - level) / m
        season = list(y[:m] - level) if seasonal == "add" else list(y[:m] / level)
        if trend == "mul":
            slope = (y[m:2 * m].mean() / level) ** (1 / m)
    else:
        level, slope = y[0], (y[1] / y[0] if trend == "mul" else y[1] - y[0])
        season = [0.0] * m
    sse = 0.0
    for t, v in enumerate(y):
        s = season[t % m]
        base = level * slope if trend == "mul" else level + slope
        fit = base * s if seasonal == "mul" else base + s
        sse += (v - fit) ** 2
        new = a * (v / s if seasonal == "mul" else v - s) + (1 - a) * base
        slope = b * (new / level if trend == "mul" else new - level) + (1 - b) * slope
        if seasonal:
            season[t % m] = g * (v / base if seasonal == "mul" else v - base) + (1 - g) * s
        level = new
    return sse, level, slope, season


@pytest.mark.parametrize("trend,seasonal", [("add", "add"), ("mul", "mul"), ("add", "mul"), ("add", None)])
def test_holt_winters_equals_plain_recursion(df, pdf, trend, seasonal):
    fits = forecasters.holt_winters_fit(df, ["k"], trend=trend, seasonal=seasonal, step=0.3)
    got = {r["k"]: r for r in fits.collect()}
    ahead = forecasters.holt_winters_forecast(fits, ["k"], 9, trend, seasonal).toPandas()
    for k, part in pdf.groupby("k"):
        y = part["price"].to_numpy()
        kind = seasonal if len(y) >= 14 else None
        axis = np.arange(0.3, 1.0, 0.3)
        best = min(
            (plain_smoothing(y, a, b, g, 7, kind, trend) for a, b, g in itertools.product(axis, axis, axis)),
            key=lambda r: r[0])
        assert got[k]["sse"] == pytest.approx(best[0], rel=1e-9)
        n = len(y)
        want = []
        for h in range(1, 10):
            base = best[1] * best[2] ** h if trend == "mul" else best[1] + h * best[2]
            s = best[3][(n + h - 1) % 7]
            want.append(base * s if kind == "mul" else base + s if kind else base)
        mine = ahead[ahead["k"] == k].sort_values("date")["yhat"]
        np.testing.assert_allclose(mine, want, rtol=1e-8)
        assert np.isfinite(mine).all()


def test_damped_trend_levels_off(df):
    far = forecasters.holt_winters(df, ["k"], 200, seasonal=None, damped=True).where("k = 'a'").orderBy("date").toPandas()["yhat"]
    assert abs(far.iloc[-1] - far.iloc[-2]) < abs(far.iloc[1] - far.iloc[0]) + 1e-12


def test_ar_coefficients_equal_least_squares(df, pdf):
    found = forecasters.ar_candidates(forecasters.ar_moments(df, ["k"]), ["k"]).toPandas()
    y = pdf.loc[pdf["k"] == "a", "price"].to_numpy()
    for d, p, s in ((0, 2, 0), (1, 3, 1), (2, 5, 0)):
        z = np.diff(y, n=d)
        z = z - z.mean()
        lags = [*range(1, p + 1), *([7] if s else [])]
        x = np.array([[1.0, *(z[t - k] for k in lags)] for t in range(7, len(z))])
        coef, *_ = np.linalg.lstsq(x, z[7:], rcond=None)
        sse = float(((z[7:] - x @ coef) ** 2).sum())
        n = len(z) - 7
        row = found[(found["k"] == "a") & (found["d"] == d) & (found["p"] == p) & (found["seasonal"] == s)].iloc[0]
        mine = [row["coef"][0], *(row["coef"][k] for k in range(1, p + 1)), *([row["coef"][6]] if s else [])]
        np.testing.assert_allclose(mine, coef, atol=1e-6)
        assert row["aic"] == pytest.approx(n * math.log(sse / n) + 2 * (len(coef) + 1), rel=1e-6)
    assert "tiny" not in set(found.loc[found["seasonal"] == 1, "k"])


def test_ar_select_and_forecast(df, pdf):
    best = forecasters.ar_select(df, ["k"], criterion="bic")
    assert best.count() == 3
    ahead = forecasters.ar_forecast(df, best, ["k"], 14).toPandas()
    assert len(ahead) == 3 * 14 and np.isfinite(ahead["yhat"]).all()
    a = ahead[ahead["k"] == "a"].sort_values("date")["yhat"].to_numpy()
    y = pdf.loc[pdf["k"] == "a", "price"].to_numpy()
    assert np.abs(a - y[-14:]).mean() < 6
    with pytest.raises(ValueError):
        forecasters.ar_select(df, ["k"], criterion="r2")


@pytest.mark.parametrize("d", [0, 1, 2])
def test_ar_forecast_equals_plain_iteration(spark, df, pdf, d):
    found = forecasters.ar_candidates(forecasters.ar_moments(df, ["k"]), ["k"])
    pick = found.where((F.col("d") == d) & (F.col("p") == 3) & (F.col("seasonal") == 1) & (F.col("k") == "a"))
    got = forecasters.ar_forecast(df.where("k = 'a'"), pick, ["k"], 5).orderBy("date").toPandas()["yhat"]
    coef = pick.first()["coef"]
    y = list(pdf.loc[pdf["k"] == "a", "price"])
    centre = float(np.mean(np.diff(np.array(y), n=d)))
    for _ in range(5):
        z = np.diff(np.array(y), n=d) - centre
        nxt = coef[0] + sum(c * z[-k] for c, k in zip(coef[1:], forecasters.AR_LAGS)) + centre
        y.append(nxt if d == 0 else y[-1] + nxt if d == 1 else 2 * y[-1] - y[-2] + nxt)
    np.testing.assert_allclose(got, y[-5:], rtol=1e-8)


@pytest.mark.parametrize("mode", ["add", "mul"])
def test_trend_seasonal_follows_the_signal(df, pdf, mode):
    fits = forecasters.trend_seasonal_fit(df, ["k"], mode=mode, changepoints=3)
    parts = forecasters.forecast_components(df.select("k", "date"), fits, ["k"], changepoints=3, mode=mode).toPandas()
    merged = parts.merge(pdf, on=["k", "date"])
    a = merged[merged["k"] == "a"]
    assert np.abs(a["yhat"] - a["price"]).mean() < 0.8
    if mode == "add":
        np.testing.assert_allclose(a["trend"] + a["weekly"] + a["yearly"], a["yhat"], rtol=1e-9)
    else:
        np.testing.assert_allclose(a["trend"] * a["weekly"] * a["yearly"], a["yhat"], rtol=1e-9)


def test_trend_seasonal_uses_its_regressors(spark):
    rng = np.random.default_rng(3)
    start, n, ahead = dt.date(2020, 1, 1), 300, 20
    x = rng.normal(0, 1, n + ahead)
    days = [start + dt.timedelta(days=i) for i in range(n + ahead)]
    pdf = pd.DataFrame({"k": "a", "date": days, "x": x, "price": 100 + 5 * x})
    known, future = spark.createDataFrame(pdf[:n]), spark.createDataFrame(pdf[n:].drop(columns="price"))
    options = {"regressors": ["x"], "changepoints": 3}
    with pytest.raises(ValueError):
        forecasters.trend_seasonal_forecast(known, ["k"], ahead, **options)
    got = forecasters.trend_seasonal_forecast(known, ["k"], ahead + 1, future=future, **options).orderBy("date").toPandas()
    np.testing.assert_allclose(got["yhat"][:ahead], 100 + 5 * x[n:], atol=0.2)
    assert len(got) == ahead + 1 and math.isnan(got["yhat"][ahead])  # no regressor, no forecast
    past = forecasters.trend_seasonal_forecast(known, ["k"], 0, include_history=True, **options).orderBy("date").toPandas()
    left = pdf["price"][:n] - past["yhat"]
    # First-order conditions of the ridge: free level, penalised regressor.
    coef = forecasters.trend_seasonal_fit(known, ["k"], **options).first()["coef"]
    assert abs(left.sum()) < 1e-4
    assert abs((left * x[:n]).sum() - 0.1 * coef[-1]) < 1e-4


def test_trend_seasonal_skips_days_without_regressor(spark):
    start = dt.date(2020, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), 10.0 + (i % 5), None if i == 7 else float(i % 5)) for i in range(60)]
    known = spark.createDataFrame(rows, "k string, date date, price double, x double")
    assert forecasters.trend_seasonal_fit(known, ["k"], regressors=["x"], changepoints=2).first()["n"] == 59


def test_intervals_and_names():
    assert forecasters.list_models() == ["ar", "baseline", "gbt", "holt_winters", "huber", "ridge", "trend_seasonal"]
    with pytest.raises(ValueError):
        forecasters.get_model("lstm")


def long_table(spark, rows):
    return spark.createDataFrame(rows, "model string, idx long, y_true double, y_pred double")


def test_forecasts_that_are_missing_have_no_weight(spark):
    rows = long_table(spark, [("m", 0, 1.0, 10.0), ("o", 0, 1.0, None)])
    weights = spark.createDataFrame([("m", 0.5), ("o", 0.5)], "model string, weight double")
    assert ensemble.ensemble_weighted(rows, weights, ["idx"]).first()["y_pred"] == 10.0


def test_metric_edges(spark):
    one = long_table(spark, [("m", 0, 0.0, 1.0)])
    got = metrics.forecast_metrics(one).first()
    assert got["mape"] == float("inf") and got["r2"] == 0.0 and got["directional_acc"] == 0.0
    capped = metrics.metric_table(one, {"m": metrics.mape_capped()}).first()["m"]
    assert capped == 999.9


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_directional_accuracy_across_blocks(spark, block_rows):
    rng = np.random.default_rng(2)
    y, p = rng.normal(size=50), rng.normal(size=50)
    rows = long_table(spark, [("m", i, float(y[i]), float(p[i])) for i in range(50)])
    want = (np.sign(np.diff(y)) == np.sign(np.diff(p))).mean() * 100
    got = metrics.directional_accuracy(rows, block_rows=block_rows).first()["directional_acc"]
    assert got == pytest.approx(want)


def test_spearman_with_ties(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 6, 200).astype(float), rng.integers(-3, 3, 200).astype(float)
    rows = long_table(spark, [("m", i, float(y[i]), float(p[i])) for i in range(200)])
    want = np.corrcoef(pd.Series(y).rank(), pd.Series(p).rank())[0, 1]
    assert metrics.information_coefficient(rows).first()["ic"] == pytest.approx(want)


def student_two_sided(t: float, df: int) -> float:
    """Twice the upper tail of Student's t, by the trapezoid rule over an angle: t = sqrt(df) tan(u)."""
    u = np.linspace(math.atan(t / math.sqrt(df)), math.pi / 2, 400_001)
    area = np.trapezoid(np.cos(u) ** (df - 1), u)
    return 2 * area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)


def test_correlation_pvalues_equal_student(spark):
    cases = [(r, n) for r in (0.0, 1e-6, 0.01, 0.1, -0.3, 0.5, 0.75, -0.9, 0.99, 0.9999) for n in (3, 4, 5, 12, 60, 1000, 250_000)]
    rows = spark.createDataFrame(cases, "r double, n long")
    got = rows.select("r", "n", correlation_pvalue(F.col("r"), F.col("n")).alias("p")).collect()
    for row in got:
        df = row["n"] - 2
        t = abs(row["r"]) * math.sqrt(df / (1 - row["r"] ** 2))
        assert row["p"] == pytest.approx(student_two_sided(t, df), abs=1e-9), row
    # Printed table of Student's t, two-sided 5 % points.
    for df, t in ((1, 12.7062047), (2, 4.30265273), (10, 2.22813885), (30, 2.04227246), (120, 1.97993041)):
        r = t / math.sqrt(df + t * t)
        p = spark.range(1).select(correlation_pvalue(F.lit(r), F.lit(df + 2))).first()[0]
        assert p == pytest.approx(0.05, abs=1e-8)
    odd = spark.createDataFrame([(0.5, 2), (None, 9), (1.0, 9), (-1.0, 3)], "r double, n long")
    assert [x[0] for x in odd.select(correlation_pvalue(F.col("r"), F.col("n"))).collect()] == [None, None, 0.0, 0.0]


def test_wins_tie_goes_to_first_name(spark):
    table = spark.createDataFrame([("b", 1.0, 0.5), ("a", 1.0, 0.2)], "model string, rmse double, r2 double")
    best = {r["metric"]: r["best"] for r in metrics.best_per_metric(table, ["rmse", "r2"]).collect()}
    assert best == {"rmse": "a", "r2": "b"}
    rec = [r["model"] for r in metrics.model_wins(table, ["rmse", "r2"]).where("recommended").collect()]
    assert rec == ["a"]


def test_ensembles(spark):
    rows = long_table(spark, [("a", 0, 1.0, 2.0), ("a", 1, 2.0, 3.0), ("b", 0, 1.0, 1.5), ("b", 1, 2.0, float("nan"))])
    fixed = ensemble.repair_predictions(rows)
    assert {(r["model"], r["idx"]): r["y_pred"] for r in fixed.collect()}[("b", 1)] == 1.5
    w = {r["model"]: r["weight"] for r in ensemble.ensemble_weights(fixed).collect()}
    assert w["a"] == pytest.approx(0.2) and w["b"] == pytest.approx(0.8)
    mixed = {r["idx"]: r["y_pred"] for r in ensemble.combine(fixed, "weighted").collect()}
    assert mixed[0] == pytest.approx(0.2 * 2.0 + 0.8 * 1.5)
    with pytest.raises(ValueError):
        ensemble.combine(fixed, "median")
    scores = spark.createDataFrame([("a", None), ("b", 0.1), ("c", -1.0)], "model string, r2 double")
    assert [r["model"] for r in ensemble.top_models(scores, 2).collect()] == ["b", "a"]


def test_stacking_finds_the_weights(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=300), rng.normal(size=300)
    y = 0.3 * a + 0.7 * b
    rows = spark.createDataFrame(
        [(m, i, float(y[i]), float(v[i])) for m, v in (("a", a), ("b", b)) for i in range(300)],
        "model string, idx long, y_true double, y_pred double")
    wide = ensemble.stack_predictions(rows, ["b", "a"], ["idx", "y_true"])
    model = ensemble.fit_stacking(wide, ["a", "b"], ridge=1e-9)
    assert list(model.coefficients) == pytest.approx([0.3, 0.7], abs=1e-4)
    out = ensemble.apply_stacking(model, wide, ["a", "b"]).toPandas()
    np.testing.assert_allclose(out["y_stack"], out["y_true"], atol=1e-3)


@pytest.mark.parametrize("kind", ["ridge", "huber", "gbt"])
def test_regressors_on_columns(spark, kind):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 2))
    rows = spark.createDataFrame([(float(u), float(v), float(2 * u - v)) for u, v in x], "u double, v double, y double")
    model = forecasters.fit_columns_regressor(rows, ["u", "v"], "y", kind)
    out = model.transform(rows).toPandas()
    assert np.corrcoef(out["y_pred"], out["y"])[0, 1] > 0.95


def test_qq_quantiles(spark):
    ps = [0.001, 0.02, 0.1, 0.5, 0.9, 0.99, 0.9995]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(profile.inverse_normal(F.col("p"))).collect()
    from statistics import NormalDist

    np.testing.assert_allclose([r[0] for r in got], [NormalDist().inv_cdf(p) for p in ps], atol=1e-7)


def test_error_quarters_are_cut_at_whole_shares(spark):
    rows = long_table(spark, [("m", i, float(i), 0.0) for i in range(11)]).withColumn("place", F.col("idx"))
    got = {r["quarter"]: r["n"] for r in profile.error_by_quarter(rows, ["model"]).collect()}
    assert got == {1: 2, 2: 3, 3: 3, 4: 3}
    few = {r["quarter"]: r["n"] for r in profile.error_by_quarter(rows.limit(3), ["model"]).collect()}
    assert few == {2: 1, 3: 1, 4: 1}


def test_selection_drops_flat_columns(spark):
    rows = spark.createDataFrame([(float(i), 1.0, float(-i), float(i * i % 7)) for i in range(20)], "y double, c double, n double, o double")
    assert selection.select_features(rows, ["c", "o", "n"], "y", 2) == ["n", "o"]
    assert selection.select_features(rows, ["c", "o", "n"], "y", 2, "first") == ["c", "o"]
    with pytest.raises(ValueError):
        selection.select_features(rows, ["c"], "y", 1, "mutual_info")
