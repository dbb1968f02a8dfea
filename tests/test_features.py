"""Features against pandas on awkward series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from pricefield.operators import daily
from pricefield.operators import features as ft


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(1)
    start = dt.date(2019, 11, 20)
    parts = []
    for name, values in {
        "walk": 100 + np.cumsum(rng.normal(0, 3, 1300)),
        "flat": np.full(80, 42.0),
        "zeros": np.where(np.arange(120) % 4 == 0, 0.0, rng.normal(10, 2, 120)),
        "short": np.array([5.0, 6.0]),
        "one": np.array([9.0]),
    }.items():
        days = [start + dt.timedelta(days=i) for i in range(len(values))]
        parts.append(pd.DataFrame({"k": name, "date": days, "price": values}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return spark.createDataFrame(pdf).repartition(6)


def by_series(pdf, fn):
    return pd.concat([fn(p.reset_index(drop=True)) for _, p in pdf.groupby("k", sort=True)], ignore_index=True)


def compare(got, want, cols, tol=1e-6):
    got = got.sort_values(["k", "date"]).reset_index(drop=True)
    want = want.sort_values(["k", "date"]).reset_index(drop=True)
    for c in cols:
        np.testing.assert_allclose(
            got[c].astype(float), want[c].astype(float), rtol=tol, atol=tol, equal_nan=True, err_msg=c)


def test_ema_equals_ewm(df, pdf):
    spans = [2, 7, 21, 200]
    got = ft.ema(df, ["k"], spans=spans).toPandas()
    want = by_series(pdf, lambda p: p.assign(**{f"ema_{s}": p["price"].ewm(span=s, adjust=False).mean() for s in spans}))
    compare(got, want, [f"ema_{s}" for s in spans], 1e-10)


def test_ema_span_one_is_the_value(df, pdf):
    got = ft.ema(df, ["k"], spans=[1, 3]).toPandas()
    compare(got, pdf.assign(ema_1=pdf["price"]), ["ema_1"])


def test_macd(df, pdf):
    def want(p):
        line = p["price"].ewm(span=12, adjust=False).mean() - p["price"].ewm(span=26, adjust=False).mean()
        sig = line.ewm(span=9, adjust=False).mean()
        return p.assign(macd=line, macd_signal=sig, macd_histogram=line - sig)

    compare(ft.macd(df, ["k"]).toPandas(), by_series(pdf, want), ["macd", "macd_signal", "macd_histogram"], 1e-9)


def reference_frame(p):
    x = p["price"]
    out = {}
    with np.errstate(all="ignore"):
        for k in ft.LAGS:
            out[f"price_lag_{k}"] = x.shift(k)
            out[f"price_pct_change_{k}"] = (x / x.shift(k) - 1) * 100
        for k in ft.WINDOWS:
            roll = x.rolling(k, min_periods=1)
            out[f"sma_{k}"], out[f"rolling_std_{k}"] = roll.mean(), roll.std()
            out[f"rolling_min_{k}"], out[f"rolling_max_{k}"] = roll.min(), roll.max()
            out[f"rolling_median_{k}"] = roll.median()
            frames = [x.iloc[max(0, i - k + 1): i + 1] for i in range(len(x))]
            out[f"rolling_skew_{k}"] = pd.Series([0.0 if len(w) >= 3 and w.min() == w.max() else w.skew() for w in frames])
            out[f"rolling_kurt_{k}"] = pd.Series([-3.0 if len(w) >= 4 and w.min() == w.max() else w.kurt() for w in frames])
        step = x.diff()
        gain, loss = step.where(step > 0, 0), (-step).where(step < 0, 0)
        for k in ft.RSI_PERIODS:
            rs = gain.rolling(k, min_periods=1).mean() / (loss.rolling(k, min_periods=1).mean() + 1e-8)
            out[f"rsi_{k}"] = 100 - 100 / (1 + rs)
        low, high = x.rolling(14, min_periods=1).min(), x.rolling(14, min_periods=1).max()
        out["stoch_k"] = 100 * (x - low) / (high - low + 1e-8)
        out["stoch_d"] = out["stoch_k"].rolling(3, min_periods=1).mean()
        mean = x.rolling(20, min_periods=1).mean()
        dev = pd.Series([np.abs(w - w.mean()).mean() for w in (x.iloc[max(0, i - 19): i + 1] for i in range(len(x)))])
        out["cci"] = (x - mean) / (0.015 * dev + 1e-8)
        out["demand_index"] = (x - x.rolling(30, min_periods=1).mean()) / (x.rolling(30, min_periods=1).mean() + 1e-8)
        out["supply_disruption_proxy"] = x.rolling(7, min_periods=1).std() / x.rolling(30, min_periods=1).std().mean()
        for k in (30, 90):
            out[f"inflation_proxy_{k}d"] = (x / x.shift(k) - 1).rolling(30, min_periods=1).mean() * 100
        past = x.shift(7)
        corr = []
        for i in range(len(x)):
            a, b = x.iloc[max(0, i - 13): i + 1], past.iloc[max(0, i - 13): i + 1]
            ok = b.notna()
            a, b = a[ok], b[ok]
            flat = len(a) < 2 or a.min() == a.max() or b.min() == b.max()
            corr.append(np.nan if flat else np.corrcoef(a, b)[0, 1])
        out["global_market_proxy"] = pd.Series(corr)
    frame = pd.DataFrame(out).ffill().bfill()
    frame = frame.replace([np.inf, -np.inf], np.nan).fillna(0)
    return pd.concat([p, frame], axis=1)


def test_all_features_equal_pandas(df, pdf):
    got = ft.all_features(df, ["k"])
    assert len(ft.feature_names(got, ["k"])) == 125
    want = by_series(pdf, reference_frame)
    cols = [c for c in want.columns if c not in ("k", "date", "price")]
    made = got.toPandas()
    compare(made, want, cols, 1e-5)
    finite = made.drop(columns=["k", "date"]).astype(float).to_numpy()
    assert np.isfinite(finite).all()


def test_division_by_zero_becomes_zero_not_the_neighbour(df, pdf):
    made = ft.all_features(df, ["k"]).toPandas()
    z = made[made["k"] == "zeros"].sort_values("date").reset_index(drop=True)
    # day 4 is 0, so day 5 over day 4 is infinite and ends as 0
    assert z["price_pct_change_1"].iloc[5] == 0
    assert z["price_pct_change_1"].iloc[4] == pytest.approx(-100)


def test_no_future_in_strict_mode(df, pdf):
    made = ft.all_features(df, ["k"], strict=True).toPandas()
    first = made[made["k"] == "walk"].sort_values("date").iloc[0]
    assert first["price_lag_30"] == 0 and first["rolling_std_7"] == 0


def test_spine_and_gap_fill(spark):
    d = dt.date
    src = spark.createDataFrame(
        [("a", d(2020, 2, 27), 1.0), ("a", d(2020, 3, 2), 5.0), ("a", d(2020, 3, 3), 2.0), ("b", d(2020, 1, 1), 3.0)],
        "k string, date date, price double")
    spine = daily.date_spine(src, ["k"]).orderBy("k", "date").toPandas()
    assert list(spine["price"].fillna(-1)) == [1, -1, -1, -1, 5, 2, 3]
    filled = daily.gap_fill_linear(src, ["k"]).orderBy("k", "date").toPandas()
    assert list(filled["price"]) == [1, 2, 3, 4, 5, 2, 3]
    ahead = daily.future_frame(src, ["k"], 2).orderBy("k", "date").toPandas()
    assert [str(v) for v in ahead["date"]] == ["2020-03-04", "2020-03-05", "2020-01-02", "2020-01-03"]


def test_weighted_mean_without_volume_is_the_mean(spark):
    src = spark.createDataFrame([("a", dt.date(2020, 1, 1), 1.0), ("a", dt.date(2020, 1, 1), 3.0)], "k string, date date, price double")
    assert daily.aggregate_daily(src, ["k"], method="weighted").first()["price"] == 2.0
    with pytest.raises(ValueError):
        daily.aggregate_daily(src, ["k"], method="mode")
