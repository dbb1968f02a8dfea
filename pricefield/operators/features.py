"""Time-series features of day-grain series.

A day-grain series holds at most one row per calendar day, so a window per series is
bounded by the calendar. All features of one pass share one window, hence one shuffle
and one sort; the passes are: from the value, from those, and from those again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import EPS, div_inf, sample_kurt, sample_skew, zero_if_not_finite
from ..functions.calendar import calendar_features, month_indices
from .daily import fill_daily

LAGS = [1, 2, 3, 5, 7, 14, 21, 30]
WINDOWS = [3, 7, 14, 21, 30]
MOMENTUM = {"short": 3, "medium": 7, "long": 14}
EMA_SPANS = [7, 14, 21]
MACD_SPANS = (12, 26, 9)
RSI_PERIODS = [7, 14, 21]
ROC_PERIODS = [7, 14, 30]


class Frames:
    """The window of a series and its trailing frames."""

    def __init__(self, series: Sequence[str], order: str = "date"):
        self.w = Window.partitionBy(*series).orderBy(order)

    def last(self, k: int):
        return self.w.rowsBetween(-(k - 1), 0)

    def lag(self, c: Column | str, k: int) -> Column:
        return F.lag(c, k).over(self.w)


# --- lags --------------------------------------------------------------------------
# Window values are computed once as plain columns (`_lag_7`, `_skew_14`); what is derived
# from them reads those columns, so no window function is evaluated twice.

def past_columns(f: Frames, x: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"_lag_{k}": f.lag(x, k) for k in lags}


def lag_columns(lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"price_lag_{k}": F.col(f"_lag_{k}") for k in lags}


def diff_columns(x: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"price_diff_{k}": F.col(x) - F.col(f"_lag_{k}") for k in lags}


def change(x: str, k: int) -> Column:
    return div_inf(F.col(x), F.col(f"_lag_{k}")) - 1


def pct_change_columns(x: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"price_pct_change_{k}": change(x, k) * 100 for k in lags}


def momentum_columns(x: str) -> dict[str, Column]:
    return {f"momentum_{name}": F.col(x) - F.col(f"_lag_{k}") for name, k in MOMENTUM.items()}


# --- trailing frames ---------------------------------------------------------------

def sma_columns(f: Frames, x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    return {f"sma_{k}": F.avg(x).over(f.last(k)) for k in windows}


def std_columns(f: Frames, x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    return {f"rolling_std_{k}": F.stddev_samp(x).over(f.last(k)) for k in windows}


def min_max_columns(f: Frames, x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    out = {}
    for k in windows:
        out[f"rolling_min_{k}"] = F.min(x).over(f.last(k))
        out[f"rolling_max_{k}"] = F.max(x).over(f.last(k))
    return out


def median_columns(f: Frames, x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    return {f"rolling_median_{k}": F.percentile(x, 0.5).over(f.last(k)) for k in windows}


def shape_columns(f: Frames, x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """Row count, population skewness and kurtosis per frame."""
    out = {}
    for k in windows:
        out[f"_n_{k}"] = F.count(x).over(f.last(k)).cast("double")
        out[f"_skew_{k}"] = F.skewness(x).over(f.last(k))
        out[f"_kurt_{k}"] = F.kurtosis(x).over(f.last(k))
    return out


def skew_columns(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    """From `shape_columns` and `min_max_columns`."""
    return {
        f"rolling_skew_{k}": sample_skew(
            F.col(f"_skew_{k}"), F.col(f"_n_{k}"), F.col(f"rolling_min_{k}"), F.col(f"rolling_max_{k}"))
        for k in windows
    }


def kurt_columns(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    # A frame shorter than four rows never has enough of them and stays NULL.
    return {
        f"rolling_kurt_{k}": sample_kurt(
            F.col(f"_kurt_{k}"), F.col(f"_n_{k}"), F.col(f"rolling_min_{k}"), F.col(f"rolling_max_{k}"))
        for k in windows
    }


def range_columns(windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    return {f"price_range_{k}": F.col(f"rolling_max_{k}") - F.col(f"rolling_min_{k}") for k in windows}


def price_to_sma_columns(x: str, windows: Sequence[int] = WINDOWS) -> dict[str, Column]:
    return {f"price_to_sma_{k}": div_inf(F.col(x), F.col(f"sma_{k}") + EPS) for k in windows}


def strict_ma_columns(f: Frames, x: str, windows: Sequence[int] = (7, 30)) -> dict[str, Column]:
    """Mean of a full frame only."""
    return {
        f"ma_{k}": F.when(F.count(x).over(f.last(k)) == k, F.avg(x).over(f.last(k))) for k in windows
    }


# --- exponential means -------------------------------------------------------------

def _chunk_groups(spans: dict[str, tuple[str, int]]) -> list[tuple[int, dict[str, tuple[str, float]]]]:
    """(chunk length, {name: (column, keep)}): spans whose weights stay finite over one length."""
    decay = {n: -math.log((s - 1) / (s + 1)) if s > 1 else math.inf for n, (_, s) in spans.items()}
    groups: list[tuple[int, dict]] = []
    for name in sorted(spans, key=lambda n: decay[n]):
        own = max(2, math.ceil(41.5 / decay[name]))
        if not groups or groups[-1][0] * decay[name] > 600:
            groups.append((own, {}))
        groups[-1][1][name] = (spans[name][0], math.exp(-decay[name]))
    return groups


def with_emas(
    df: DataFrame, series: Sequence[str], values: dict[str, tuple[str, int]], order: str = "date"
) -> DataFrame:
    """Add e[t] = a*x[t] + (1-a)*e[t-1], e[0] = x[0], a = 2/(span+1); {name: (column, span)}.

    t counts the known values: the mean starts at the first one, and a missing value leaves it as it was
    (as pandas does with ignore_na).

    The recursion unrolls to a weighted running sum. Rows are cut into chunks so long that a
    weight of the chunk before last is under 1e-18: a row needs its own chunk's running
    sum and the last sum of the chunk before.
    """
    known = Window.partitionBy(*series).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    columns = sorted({x for x, _ in values.values()})
    rows = df.withColumns({f"_t_{x}": F.count(x).over(known) - 1 for x in columns})
    groups = [
        (chunk, x, {name: v for name, v in group.items() if v[0] == x}) for chunk, group in _chunk_groups(values) for x in columns
    ]
    for chunk, column, group in groups:
        if not group:
            continue
        t = F.col(f"_t_{column}")
        rows = rows.withColumns({"_t": t, "_c": F.floor(t / chunk), "_j": F.pmod(t, F.lit(chunk))})
        inside = Window.partitionBy(*series, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        sums = {}
        for name, (x, q) in group.items():
            part = F.when(F.col("_t") == 0, F.col(x)).otherwise(F.col(x) * (1 - q))
            grown = F.sum(part * F.pow(F.lit(q), -F.col("_j"))).over(inside)
            sums[f"_s_{name}"] = grown * F.pow(F.lit(q), F.col("_j")) if q else F.last(x, ignorenulls=True).over(inside)
        rows = rows.withColumns(sums)
        before = Window.partitionBy(*series).orderBy("_c").rangeBetween(-1, -1)
        out = {}
        for name, (_, q) in group.items():
            end = F.when(F.col("_j") == chunk - 1, F.col(f"_s_{name}"))
            carry = F.coalesce(F.max(end).over(before), F.lit(0.0))
            out[name] = F.col(f"_s_{name}") + carry * F.pow(F.lit(q), F.col("_j") + 1)
        rows = rows.withColumns(out).drop("_t", "_c", "_j", *sums)
    return rows.drop(*[f"_t_{x}" for x in columns])


def ema(df: DataFrame, series: Sequence[str], x: str = "price", spans: Sequence[int] = EMA_SPANS) -> DataFrame:
    return with_emas(df, series, {f"ema_{s}": (x, s) for s in spans})


def ema_cross_columns() -> dict[str, Column]:
    return {
        "ema_7_21_ratio": div_inf(F.col("ema_7"), F.col("ema_21") + EPS),
        "ema_crossover": (F.col("ema_7") > F.col("ema_21")).cast("int"),
    }


def price_pressure_column() -> Column:
    return div_inf(F.col("ema_7") - F.col("ema_21"), F.col("ema_21") + EPS)


def macd(
    df: DataFrame, series: Sequence[str], x: str = "price", fast: int = 12, slow: int = 26, signal: int = 9
) -> DataFrame:
    rows = with_emas(df, series, {"_fast": (x, fast), "_slow": (x, slow)})
    rows = rows.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return _with_signal(rows, series, signal)


def _with_signal(df: DataFrame, series: Sequence[str], signal: int) -> DataFrame:
    rows = with_emas(df, series, {"macd_signal": ("macd", signal)})
    return rows.withColumns({
        "macd_histogram": F.col("macd") - F.col("macd_signal"),
        "macd_crossover": (F.col("macd") > F.col("macd_signal")).cast("int"),
    })


# --- indicators --------------------------------------------------------------------

def move_columns(x: str) -> dict[str, Column]:
    """Rise and fall against the row before; the first row counts as 0 and 0."""
    step = F.col(x) - F.col("_lag_1")
    return {
        "_gain": F.when(step > 0, step).otherwise(F.lit(0.0)),
        "_loss": F.when(step < 0, -step).otherwise(F.lit(0.0)),
    }


def rsi_columns(f: Frames, periods: Sequence[int] = RSI_PERIODS) -> dict[str, Column]:
    out = {}
    for k in periods:
        rs = F.avg("_gain").over(f.last(k)) / (F.avg("_loss").over(f.last(k)) + EPS)
        out[f"rsi_{k}"] = 100 - 100 / (1 + rs)
    return out


def band_columns(f: Frames, x: str, window: int = 20) -> dict[str, Column]:
    fr = f.last(window)
    return {"_mid": F.avg(x).over(fr), "_sd": F.stddev_samp(x).over(fr), "_seen": F.collect_list(x).over(fr)}


def bollinger_columns(x: str, width: float = 2.0) -> dict[str, Column]:
    """From `band_columns`."""
    mid, half = F.col("_mid"), F.col("_sd") * width
    upper, lower = mid + half, mid - half
    return {
        "bb_middle": mid,
        "bb_upper": upper,
        "bb_lower": lower,
        "bb_width": div_inf(upper - lower, mid + EPS),
        "bb_pct_b": div_inf(F.col(x) - lower, upper - lower + EPS),
    }


def cci_column(x: str) -> Column:
    """Distance from the frame's mean over its mean absolute deviation; from `band_columns`."""
    total = F.aggregate("_seen", F.lit(0.0), lambda acc, v: acc + F.abs(v - F.col("_mid")))
    return div_inf(F.col(x) - F.col("_mid"), 0.015 * total / F.size("_seen") + EPS)


def roc_columns(x: str, periods: Sequence[int] = ROC_PERIODS) -> dict[str, Column]:
    return {
        f"roc_{k}": div_inf(F.col(x) - F.col(f"_lag_{k}"), F.col(f"_lag_{k}") + EPS) * 100 for k in periods
    }


def extreme_columns(f: Frames, x: str, window: int = 14) -> dict[str, Column]:
    return {"_low": F.min(x).over(f.last(window)), "_high": F.max(x).over(f.last(window))}


def stoch_k_column(x: str) -> Column:
    """From `extreme_columns`."""
    return 100 * div_inf(F.col(x) - F.col("_low"), F.col("_high") - F.col("_low") + EPS)


def stoch_d_column(f: Frames) -> Column:
    return F.avg("stoch_k").over(f.last(3))


# --- proxies -----------------------------------------------------------------------

def change_columns(x: str) -> dict[str, Column]:
    """Relative changes for means; the change from a price of 0 is missing there."""
    return {f"_chg_{k}": F.try_divide(F.col(x), F.col(f"_lag_{k}")) - 1 for k in (30, 90)}


def inflation_columns(f: Frames) -> dict[str, Column]:
    return {f"inflation_proxy_{k}d": F.avg(f"_chg_{k}").over(f.last(30)) * 100 for k in (30, 90)}


def spread_columns(f: Frames, x: str) -> dict[str, Column]:
    return {
        "_std_7": F.stddev_samp(x).over(f.last(7)), "_std_30": F.stddev_samp(x).over(f.last(30)),
        "_trend": F.avg(x).over(f.last(30)),
    }


def demand_column(x: str) -> Column:
    """From `spread_columns`."""
    return div_inf(F.col(x) - F.col("_trend"), F.col("_trend") + EPS)


def autocorr_column(f: Frames, x: str, past: str, window: int = 14) -> Column:
    """Correlation over the frame of x with `past` (x seven rows earlier)."""
    fr = f.last(window)
    a, b = F.when(F.col(past).isNotNull(), F.col(x)), F.col(past)
    n = F.count(b).over(fr)
    flat = (F.min(a).over(fr) == F.max(a).over(fr)) | (F.min(b).over(fr) == F.max(b).over(fr))
    spread = F.stddev_pop(a).over(fr) * F.stddev_pop(b).over(fr)
    cov = F.covar_pop(a, b).over(fr)
    return F.when((n > 1) & ~flat, F.try_divide(cov, spread))


def typical_spread_column(series: Sequence[str], strict: bool = False) -> Column:
    """Mean 30-row spread of the whole series, later days included; strict keeps to the past."""
    whole = Window.partitionBy(*series)
    if strict:
        whole = whole.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return F.avg("_std_30").over(whole)


def supply_disruption_column() -> Column:
    """7-row spread over the series' typical 30-row spread, from `_std_7` and `_typical`."""
    return div_inf(F.col("_std_7"), F.col("_typical"))


# --- the whole set -----------------------------------------------------------------

def all_features(
    df: DataFrame,
    series: Sequence[str],
    x: str = "price",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    external: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Day-grain (series, date, x) to the full feature frame, gaps filled, no infinities."""
    f = Frames(series)
    # Features cost far more than the thin rows they start from. A shuffle with a count of its
    # own is neither merged into the one below nor coalesced by size at run time.
    parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*series, "date", x).repartition(parts, *series)
    fast, slow, signal = MACD_SPANS
    spans = {f"ema_{s}": (x, s) for s in EMA_SPANS} | {"_fast": (x, fast), "_slow": (x, slow)}
    rows = with_emas(rows, series, spans).withColumn("macd", F.col("_fast") - F.col("_slow"))
    rows = _with_signal(rows, series, signal)
    needed = {*lags, *MOMENTUM.values(), *ROC_PERIODS, 1, *((7, 30, 90) if external else ())}
    base = {
        **past_columns(f, x, sorted(needed)), **sma_columns(f, x, windows), **std_columns(f, x, windows),
        **min_max_columns(f, x, windows), **median_columns(f, x, windows), **shape_columns(f, x, windows),
        **band_columns(f, x), **extreme_columns(f, x), **(spread_columns(f, x) if external else {}),
    }
    rows = rows.withColumns(base)
    first = {
        **lag_columns(lags), **diff_columns(x, lags), **pct_change_columns(x, lags), **momentum_columns(x),
        **skew_columns(windows), **kurt_columns(windows), **range_columns(windows),
        **price_to_sma_columns(x, windows), **bollinger_columns(x), **roc_columns(x), **ema_cross_columns(),
        "cci": cci_column(x), "stoch_k": stoch_k_column(x), **move_columns(x), **calendar_features(),
    }
    if external:
        first |= {
            **change_columns(x), **month_indices(), "demand_index": demand_column(x),
            "price_pressure": price_pressure_column(),
        }
    rows = rows.withColumns(first)
    second = {**rsi_columns(f), "stoch_d": stoch_d_column(f)}
    if external:
        second |= {
            **inflation_columns(f), "global_market_proxy": autocorr_column(f, x, "_lag_7"),
            "_typical": typical_spread_column(series, strict),
        }
    rows = rows.withColumns(second)
    if external:
        rows = rows.withColumn("supply_disruption_proxy", supply_disruption_column())
    rows = rows.drop(*[c for c in rows.columns if c.startswith("_")])
    names = [c for c in rows.columns if c not in (*series, "date")]
    ints = [n for n, t in rows.dtypes if t in ("int", "bigint")]
    floats = [n for n in names if n not in ints]
    rows = fill_daily(rows, series, floats, strict=strict)
    return rows.withColumns({c: zero_if_not_finite(c) for c in floats})


def feature_names(df: DataFrame, series: Sequence[str], x: str = "price") -> list[str]:
    return [c for c in df.columns if c not in (*series, "date", x)]
