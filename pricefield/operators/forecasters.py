"""Forecasters fitted for every series at once.

Input is day-grain (series, date, y) without gaps. A series is bounded by the calendar, so
one series fits a task; thousands of series run side by side. Only the recursion and the
small linear solves are Python, on Arrow batches; candidates are compared and forecasts
are laid out by Spark.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .daily import future_frame

PERIOD = 7

# Two-sided normal quantiles.
NORMAL_Z = {0.10: 1.645, 0.05: 1.96, 0.01: 2.576}


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


# --- naive ---------------------------------------------------------------------------

def baseline_forecasts(df: DataFrame, series: Sequence[str], y: str = "price", date: str = "date") -> DataFrame:
    """Last value, value a week ago and mean of the past week, as three models."""
    w = Window.partitionBy(*series).orderBy(date)
    rows = df.select(
        *series, date, F.col(y).alias("y_true"),
        (F.row_number().over(w) - 1).cast("long").alias("idx"),
        F.lag(y, 1).over(w).alias("naive"),
        F.lag(y, PERIOD).over(w).alias("seasonal_naive"),
        F.avg(y).over(w.rowsBetween(-PERIOD, -1)).alias("sma_7"),
    )
    long = rows.unpivot(
        [*series, date, "idx", "y_true"], ["naive", "seasonal_naive", "sma_7"], "model", "y_pred"
    )
    return long.where("y_pred IS NOT NULL").select("model", *series, date, "idx", "y_true", "y_pred")


# --- exponential smoothing -------------------------------------------------------------

def smoothing_grid(step: float = 0.2, damped: bool = False) -> np.ndarray:
    """(alpha, beta, gamma, phi) candidates."""
    axis = np.arange(step, 1.0, step)
    phis = [0.8, 0.9, 0.98] if damped else [1.0]
    return np.array(list(itertools.product(axis, axis, axis, phis)))


def smooth(y: np.ndarray, grid: np.ndarray, trend: str | None, seasonal: str | None, m: int) -> dict[str, np.ndarray]:
    """Run the smoothing recursion for all parameter rows side by side."""
    a, b, g, phi = grid.T
    if seasonal:
        level = np.full(len(grid), y[:m].mean())
        start = (y[m:2 * m].mean() - y[:m].mean()) / m
        first = y[:m] / y[:m].mean() if seasonal == "mul" else y[:m] - y[:m].mean()
        season = np.tile(first, (len(grid), 1))
        if trend == "mul":
            start = (y[m:2 * m].mean() / y[:m].mean()) ** (1 / m)
    else:
        level = np.full(len(grid), y[0])
        season = np.full((len(grid), m), 1.0 if seasonal == "mul" else 0.0)
        start = (y[1] / y[0] if trend == "mul" else y[1] - y[0]) if len(y) > 1 else float(trend == "mul")
    flat = 1.0 if trend == "mul" else 0.0
    slope = np.full(len(grid), start if trend else flat)
    sse = np.zeros(len(grid))
    for t, value in enumerate(y):
        s = season[:, t % m]
        base = level * slope ** phi if trend == "mul" else level + phi * slope
        fit = base * s if seasonal == "mul" else base + s
        sse += (value - fit) ** 2
        clear = value / s if seasonal == "mul" else value - s
        new = a * clear + (1 - a) * base
        if trend == "mul":
            slope = b * (new / level) + (1 - b) * slope ** phi
        elif trend:
            slope = b * (new - level) + (1 - b) * phi * slope
        if seasonal:
            rest = value / base if seasonal == "mul" else value - base
            season[:, t % m] = g * rest + (1 - g) * s
        level = new
    return {"level": level, "slope": slope, "season": season, "sse": sse}


def holt_winters_fit(
    df: DataFrame, series: Sequence[str], y: str = "price", date: str = "date", trend: str | None = "add",
    seasonal: str | None = "add", period: int = PERIOD, damped: bool = False, step: float = 0.2,
) -> DataFrame:
    """Best-fitting parameters and final state per series.

    A series shorter than two periods gets no season.
    """
    grid = smoothing_grid(step, damped)
    keys = list(series)
    out = T.StructType([
        *_fields(df, keys),
        T.StructField("params", T.ArrayType(T.DoubleType())),
        T.StructField("level", T.DoubleType()),
        T.StructField("slope", T.DoubleType()),
        T.StructField("season", T.ArrayType(T.DoubleType())),
        T.StructField("sse", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("last_date", T.DateType()),
    ])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        values = pdf[y].to_numpy(dtype=float)
        kind = seasonal if len(values) >= 2 * period else None
        end = smooth(values, grid, trend, kind, period)
        if kind is None and seasonal == "mul":
            end["season"] = np.ones_like(end["season"])
        return pd.DataFrame({
            **{k: [pdf[k].iloc[0]] * len(grid) for k in keys},
            "params": list(grid), "level": end["level"], "slope": end["slope"],
            "season": list(end["season"]), "sse": end["sse"], "n": len(values),
            "last_date": pdf[date].iloc[-1],
        })

    fits = df.select(*keys, date, y).groupBy(*keys).applyInPandas(fit, out)
    rest = [f.name for f in out if f.name not in keys]
    best = fits.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("sse", "params")).alias("b"))
    return best.select(*keys, "b.*")


def holt_winters_forecast(
    fits: DataFrame, series: Sequence[str], periods: int, trend: str | None = "add", seasonal: str | None = "add",
    date: str = "date",
) -> DataFrame:
    """Forecast rows from fitted states; `resid_std` is the in-sample deviation."""
    phi = F.col("params")[3]
    h = F.col("_h")
    weight = F.when(phi == 1, h.cast("double")).otherwise(phi * (1 - F.pow(phi, h)) / (1 - phi))
    base = F.col("level") * F.pow("slope", weight) if trend == "mul" else F.col("level") + weight * F.col("slope")
    at = ((F.col("n") + h - 1) % F.size("season") + 1).cast("int")
    s = F.element_at("season", at)
    value = base * s if seasonal == "mul" else base + s
    rows = fits.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    return rows.select(
        *series, F.date_add("last_date", h).alias(date), value.alias("yhat"),
        F.sqrt(F.col("sse") / F.col("n")).alias("resid_std"),
    )


def holt_winters(
    df: DataFrame, series: Sequence[str], periods: int = 7, y: str = "price", trend: str | None = "add",
    seasonal: str | None = "add", **options,
) -> DataFrame:
    fits = holt_winters_fit(df, series, y, trend=trend, seasonal=seasonal, **options)
    return holt_winters_forecast(fits, series, periods, trend, seasonal)


def residual_std(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.stddev_pop(F.col("y_true") - F.col("y_pred")).alias("resid_std"))


def forecast_interval(df: DataFrame, alpha: float = 0.05, yhat: str = "yhat") -> DataFrame:
    """Symmetric interval around yhat from a `resid_std` column."""
    if alpha not in NORMAL_Z:
        raise ValueError(f"alpha must be one of {sorted(NORMAL_Z)}")
    half = F.col("resid_std") * NORMAL_Z[alpha]
    return df.withColumns({"lower": F.col(yhat) - half, "upper": F.col(yhat) + half})


# --- autoregression ----------------------------------------------------------------------

AR_MAX = 5
AR_LAGS = [1, 2, 3, 4, 5, PERIOD]


def ar_moments(df: DataFrame, series: Sequence[str], y: str = "price", date: str = "date", max_d: int = 2) -> DataFrame:
    """Per (series, d): spread of the d-times differenced series and its lag products."""
    w = Window.partitionBy(*series).orderBy(date)
    zs = [F.col(y)]
    rows = df.select(*series, date, y)
    for d in range(1, max_d + 1):
        name = f"_z{d}"
        rows = rows.withColumn(name, zs[-1] - F.lag(zs[-1], 1).over(w))
        zs.append(F.col(name))
    long = None
    names = ["_one", *[f"_x{k}" for k in AR_LAGS], "_y"]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    for d, z in enumerate(zs):
        centred = rows.withColumn("_mean", F.avg(z).over(Window.partitionBy(*series)))
        centred = centred.withColumn("_y", z - F.col("_mean"))
        centred = centred.withColumns(
            {"_one": F.lit(1.0), **{f"_x{k}": F.lag("_y", k).over(w) for k in AR_LAGS}}
        )
        full = centred.where(" AND ".join(f"{n} IS NOT NULL" for n in names))
        sums = full.groupBy(*series).agg(
            F.count(F.lit(1)).alias("n"), F.stddev_pop("_y").alias("spread"),
            F.max("_mean").alias("centre"),
            F.array(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("products"),
        )
        part = sums.withColumn("d", F.lit(d))
        long = part if long is None else long.unionByName(part)
    return long


def solve_orders(products: np.ndarray, n: int, seasonal: bool = True) -> list[dict]:
    """Least squares for every order from one table of lag products."""
    k = len(AR_LAGS) + 2
    gram = np.zeros((k, k))
    gram[np.triu_indices(k)] = products
    gram = gram + np.triu(gram, 1).T
    found = []
    for p, s in itertools.product(range(AR_MAX + 1), (0, 1) if seasonal else (0,)):
        use = [0, *range(1, p + 1), *([k - 2] if s else [])]
        beta = np.linalg.lstsq(gram[np.ix_(use, use)], gram[use, -1], rcond=None)[0]
        sse = max(float(gram[-1, -1] - beta @ gram[use, -1]), 1e-12)
        coef = np.zeros(k - 1)
        coef[use] = beta
        fit = n * math.log(sse / n)
        found.append({
            "p": p, "seasonal": s, "sigma2": sse / n, "coef": coef,
            "aic": fit + 2 * (len(use) + 1), "bic": fit + math.log(n) * (len(use) + 1),
        })
    return found


def ar_candidates(moments: DataFrame, series: Sequence[str], seasonal: bool = True) -> DataFrame:
    keys = list(series)
    out = T.StructType([
        *_fields(moments, keys),
        *[T.StructField(n, T.IntegerType()) for n in ("d", "p", "seasonal")],
        *[T.StructField(n, T.DoubleType()) for n in ("spread", "centre", "sigma2", "aic", "bic")],
        T.StructField("coef", T.ArrayType(T.DoubleType())),
    ])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                {**{k: r[k] for k in keys}, "d": r["d"], "spread": r["spread"], "centre": r["centre"], **found}
                for r in pdf.to_dict("records")
                for found in solve_orders(np.asarray(r["products"]), r["n"], seasonal and r["n"] >= 14)
            ]
            yield pd.DataFrame(rows, columns=[f.name for f in out])

    return moments.mapInPandas(solve, out)


def ar_select(
    df: DataFrame, series: Sequence[str], y: str = "price", date: str = "date", criterion: str = "aic",
    seasonal: bool = True, max_d: int = 2,
) -> DataFrame:
    """Per series: d of the calmest differenced series, then the order of lowest AIC or BIC."""
    if criterion not in ("aic", "bic"):
        raise ValueError(f"unknown criterion: {criterion}")
    keys = list(series)
    found = ar_candidates(ar_moments(df, keys, y, date, max_d), keys, seasonal)
    rest = [c for c in found.columns if c not in keys]
    best = found.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct("spread", "d", criterion, "p")).alias("b")
    )
    return best.select(*keys, "b.*")


def ar_forecast(
    df: DataFrame, models: DataFrame, series: Sequence[str], periods: int = 7, y: str = "price", date: str = "date"
) -> DataFrame:
    """Iterate the chosen recursion from each series' last values."""
    keys = list(series)
    w = Window.partitionBy(*keys).orderBy(F.desc(date))
    # d differences and PERIOD lags reach PERIOD + 2 rows back.
    tail = df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= PERIOD + 3)
    ends = tail.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(date, y))), lambda s: s[y]).alias("_tail"),
        F.max(date).alias("_end"),
    )
    rows = ends.join(models, keys)
    out = T.StructType([
        *_fields(df, keys), T.StructField(date, T.DateType()), T.StructField("yhat", T.DoubleType())
    ])

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for r in pdf.to_dict("records"):
                seen = np.asarray(r["_tail"], dtype=float)
                d, coef = int(r["d"]), np.asarray(r["coef"])
                z = list(np.diff(seen, n=d) - r["centre"])
                ends_at = [np.diff(seen, n=i)[-1] for i in range(d)]
                for h in range(1, periods + 1):
                    nxt = coef[0] + sum(c * z[-k] for c, k in zip(coef[1:], AR_LAGS) if c and k <= len(z))
                    z.append(nxt)
                    value = nxt + r["centre"]
                    for i in reversed(range(d)):
                        ends_at[i] += value
                        value = ends_at[i]
                    made.append({**{k: r[k] for k in keys}, date: r["_end"] + pd.Timedelta(days=h), "yhat": value})
            yield pd.DataFrame(made, columns=[f.name for f in out])

    return rows.mapInPandas(step, out)


# --- trend and seasons ---------------------------------------------------------------------

YEAR_DAYS = 365.25
WEEK_ORDER, YEAR_ORDER = 3, 10


def design(t: Column, day: Column, changepoints: int, regressors: Sequence[str] = ()) -> dict[str, Column]:
    """Blocks of design columns. t is 0 at a series' first and 1 at its last fitted day."""
    knots = [0.8 * i / (changepoints + 1) for i in range(1, changepoints + 1)]
    trend = F.array(F.lit(1.0), t, *[F.greatest(t - k, F.lit(0.0)) for k in knots])

    def waves(period: float, order: int) -> Column:
        angles = [day * (2 * math.pi * k / period) for k in range(1, order + 1)]
        return F.array(*[f(a) for a in angles for f in (F.sin, F.cos)])

    blocks = {"trend": trend, "weekly": waves(7.0, WEEK_ORDER), "yearly": waves(YEAR_DAYS, YEAR_ORDER)}
    if regressors:
        blocks["regressors"] = F.array(*[F.col(c).cast("double") for c in regressors])
    return blocks


def _positions(df: DataFrame, ends: DataFrame, series: Sequence[str], date: str) -> DataFrame:
    span = F.greatest(F.datediff("_end", "_begin"), F.lit(1)).cast("double")
    rows = df.join(ends, list(series))
    return rows.withColumns({
        "_t": F.datediff(date, "_begin") / span,
        "_day": F.unix_date(date).cast("double"),
    })


def trend_seasonal_fit(
    df: DataFrame, series: Sequence[str], y: str = "price", date: str = "date", changepoints: int = 10,
    ridge: float = 0.1, mode: str = "add", regressors: Sequence[str] = (),
) -> DataFrame:
    """Per series the ridge coefficients of trend, weekly, yearly and regressor terms; mode 'mul' fits logs.

    Days that miss the value or a regressor take no part in the fit.
    """
    keys = list(series)
    ends = df.groupBy(*keys).agg(F.min(date).alias("_begin"), F.max(date).alias("_end"))
    rows = _positions(df, ends, keys, date)
    blocks = design(F.col("_t"), F.col("_day"), changepoints, regressors)
    target = F.log(y) if mode == "mul" else F.col(y).cast("double")
    rows = rows.select(*keys, "_begin", "_end", F.concat(*blocks.values()).alias("_x"), target.alias("_y"))
    rows = rows.where(F.col("_y").isNotNull() & ~F.exists("_x", lambda v: v.isNull()))
    out = T.StructType([
        *_fields(df, keys),
        T.StructField("_begin", T.DateType()),
        T.StructField("_end", T.DateType()),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("resid_std", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, v = np.stack(pdf["_x"].to_numpy()), pdf["_y"].to_numpy()
        penalty = np.full(x.shape[1], ridge)
        penalty[:2] = 1e-9
        coef = np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ v)
        first = pdf.iloc[0]
        return pd.DataFrame([{
            **{k: first[k] for k in keys}, "_begin": first["_begin"], "_end": first["_end"],
            "coef": coef, "resid_std": float(np.std(v - x @ coef)), "n": len(v),
        }])

    return rows.groupBy(*keys).applyInPandas(fit, out)


def _dot(xs: Column, coef: Column) -> Column:
    return F.aggregate(F.zip_with(xs, coef, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def forecast_components(
    df: DataFrame, fits: DataFrame, series: Sequence[str], date: str = "date", changepoints: int = 10,
    mode: str = "add", regressors: Sequence[str] = (),
) -> DataFrame:
    """yhat and its parts for any (series, date) rows; in mode 'mul' the parts are factors."""
    rows = _positions(df, fits.select(*series, "_begin", "_end", "coef", "resid_std"), series, date)
    blocks = design(F.col("_t"), F.col("_day"), changepoints, regressors)
    widths = {"trend": changepoints + 2, "weekly": 2 * WEEK_ORDER, "yearly": 2 * YEAR_ORDER}
    widths["regressors"] = len(regressors)
    parts, at = {}, 1
    for name, xs in blocks.items():
        parts[name] = _dot(xs, F.slice("coef", at, widths[name]))
        at += widths[name]
    rows = rows.withColumns(parts)
    names = list(parts)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    if mode == "mul":
        rows = rows.withColumn("yhat", F.exp(total)).withColumns({n: F.exp(n) for n in names})
    else:
        rows = rows.withColumn("yhat", total)
    return rows.select(*series, date, "yhat", *names, "resid_std")


def trend_seasonal_forecast(
    df: DataFrame, series: Sequence[str], periods: int = 30, include_history: bool = False, y: str = "price",
    future: DataFrame | None = None, **options,
) -> DataFrame:
    """Fit and forecast `periods` days per series.

    Regressors of the days to come are read from future(series, date, regressors); those of known days come
    from df. A day without them has no forecast.
    """
    regressors = list(options.get("regressors", ()))
    if regressors and future is None and periods > 0:
        raise ValueError("a forecast with regressors needs their values on the days to come")
    fits = trend_seasonal_fit(df, series, y, **options)
    date = options.get("date", "date")
    days = future_frame(df, series, periods, include_history, date)
    if regressors:
        wanted = [*series, date, *regressors]
        known = df.select(wanted)
        if future is not None:
            known = known.unionByName(future.select(wanted).join(df.select(*series, date), [*series, date], "left_anti"))
        days = days.join(known, [*series, date], "left")
    shared = {k: v for k, v in options.items() if k in ("date", "changepoints", "mode", "regressors")}
    return forecast_components(days, fits, series, **shared)


# --- pooled regressors on look-back windows ---------------------------------------------------

REGRESSORS: dict[str, Callable[[], object]] = {
    "ridge": lambda: LinearRegression(
        featuresCol="features", labelCol="label", predictionCol="y_pred", regParam=1e-3, solver="normal"
    ),
    "huber": lambda: LinearRegression(
        featuresCol="features", labelCol="label", predictionCol="y_pred", loss="huber", maxIter=50
    ),
    "gbt": lambda: GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="y_pred", maxIter=10, maxDepth=4, seed=7
    ),
}


def flat_vectors(windows: DataFrame) -> DataFrame:
    return windows.withColumn("features", array_to_vector(F.flatten("win"))).drop("win")


def fit_window_regressor(train: DataFrame, kind: str = "ridge") -> PipelineModel:
    """Next value from a flattened look-back window, one model over all series."""
    if kind not in REGRESSORS:
        raise ValueError(f"unknown regressor: {kind}; known: {sorted(REGRESSORS)}")
    return Pipeline(stages=[REGRESSORS[kind]()]).fit(flat_vectors(train).select("features", "label"))


def fit_columns_regressor(train: DataFrame, features: Sequence[str], label: str, kind: str = "ridge") -> PipelineModel:
    """Same regressors on plain columns."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = train.withColumn("label", F.col(label))
    return Pipeline(stages=[assemble, REGRESSORS[kind]()]).fit(rows.select(*features, "label"))


def batch_score(path: str, windows: DataFrame, shift: Column | float = 0.0, size: Column | float = 1.0) -> DataFrame:
    """Load a saved model, score windows, bring forecast and label back to the price scale."""
    scored = PipelineModel.load(path).transform(flat_vectors(windows)).drop("features")
    back = {c: F.col(c) * size + shift for c in ("y_pred", "label")}
    return scored.withColumns(back).withColumnRenamed("label", "y_true")


FORECASTERS: dict[str, Callable[..., DataFrame]] = {
    "baseline": baseline_forecasts,
    "holt_winters": holt_winters,
    "ar": lambda df, series, periods=7, **o: ar_forecast(df, ar_select(df, series, **o), series, periods),
    "trend_seasonal": trend_seasonal_forecast,
}


def list_models() -> list[str]:
    return sorted([*FORECASTERS, *REGRESSORS])


def get_model(name: str) -> Callable:
    known = {**FORECASTERS, **REGRESSORS}
    if name not in known:
        raise ValueError(f"unknown model: {name}; known: {sorted(known)}")
    return known[name]
