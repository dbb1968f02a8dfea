"""Profiling aggregates, report tables and the data behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arithmetic import nan_to_null
from .joins import attach
from .ordering import quantile_values, quantiles, sorted_rows, value_positions


# --- counts --------------------------------------------------------------------------------

def distinct_counts(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in cols]).unpivot([], list(cols), "column", "n_unique")


def distinct_sketches(df: DataFrame, by: Sequence[str], cols: Sequence[str], lg_k: int = 14) -> DataFrame:
    """One sketch per group and column, to be stored and merged later.

    A sketch takes at most about 2^lg_k bytes whatever it counts; the standard error of a merged
    estimate is about 1.04 / sqrt(2^lg_k), 0.81 % by default. Missing values are not counted.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"{c}_sketch") for c in cols])


def merged_distinct_counts(sketches: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Estimates (by, column, n_unique) of stored sketches, merged over all their other groups."""
    merged = sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"_{c}") for c in cols])
    counts = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("n_unique")) for c in cols]))
    return merged.select(*by, counts.alias("_c")).select(*by, "_c.*")


def top_values(df: DataFrame, name: str, k: int) -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(k)


def topk_share(df: DataFrame, name: str, k: int = 5) -> DataFrame:
    """Percentage among the k most frequent values."""
    top = top_values(df, name, k)
    return top.withColumn("share", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))  # k rows


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing, pct) of the columns that miss something, most missing first."""
    cols = list(cols or df.columns)
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def absent(c: str) -> Column:
        return (nan_to_null(c) if c in floats else F.col(c)).isNull()

    one = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(absent(c).cast("long")).alias(c) for c in cols]
    )
    long = one.unpivot("_rows", cols, "column", "n_missing").where("n_missing > 0")
    return long.select(
        "column", "n_missing", (F.col("n_missing") * 100.0 / F.col("_rows")).alias("pct")
    ).orderBy(F.desc("n_missing"), "column")


def extent_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_distinct("commodity").alias("n_commodities"), F.count_distinct("source").alias("n_sources"),
    )


def eda_summary(df: DataFrame, price: str = "modal_price") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_distinct(c).alias(f"unique_{n}") for c, n in
          (("commodity", "commodities"), ("state", "states"), ("market", "markets"))],
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.avg(price).alias("avg_price"), F.stddev_samp(price).alias("price_std"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
    )


# --- distributions -------------------------------------------------------------------------

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe_prices(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """One row per column: count, mean, std, min, quartiles, max.

    Columns are stacked first, so all of them share the passes over the data.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "v")
    basic = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    return basic.join(quantiles(long, "v", QUARTILES, ["column"], exact), "column")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long Pearson matrix (a, b, r) from one aggregation; each pair over the rows that have both values."""
    pairs = list(combinations(cols, 2))
    aggs = [F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    for a, b in pairs:
        both = [F.when(F.col(y).isNotNull(), F.col(x)) for x, y in ((a, b), (b, a))]
        aggs.append((F.stddev_pop(both[0]) * F.stddev_pop(both[1])).alias(f"s_{a}_{b}"))
        aggs.append(F.covar_pop(a, b).alias(f"c_{a}_{b}"))
    one = df.agg(*aggs)

    def cell(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))

    cells = [cell(c, c, F.when(F.col(f"s_{c}") > 0, F.lit(1.0))) for c in cols]
    for a, b in pairs:
        r = F.try_divide(F.col(f"c_{a}_{b}"), F.col(f"s_{a}_{b}"))
        cells += [cell(a, b, r), cell(b, a, r)]
    return one.select(F.explode(F.array(*cells)).alias("m")).select("m.*")


def seasonal_mean(df: DataFrame, unit: str, price: str = "price", date: str = "date") -> DataFrame:
    part = {"month": F.month, "weekday": F.weekday}[unit](F.col(date))
    return df.groupBy(part.alias(unit)).agg(F.avg(price).alias("avg_price"))


def histogram(df: DataFrame, x: str, bins: int = 50) -> DataFrame:
    """Equal bins between minimum and maximum, the last one closed: (bin, left, right, n).

    When all values are equal the range is widened by a half on both sides.
    """
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is not None and lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    lo, hi = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    width = (hi - lo) / bins
    place = F.least(F.floor((F.col(x) - lo) / width), F.lit(bins - 1))
    counts = df.where(F.col(x).isNotNull()).groupBy(place.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        "bin", (lo + F.col("bin") * width).alias("left"), (lo + (F.col("bin") + 1) * width).alias("right"), "n"
    )


def histogram_by(df: DataFrame, by: Sequence[str], x: str, bins: int = 30) -> DataFrame:
    """A histogram per group over the group's own range: (by, bin, left, right, n).

    A group whose values are all equal gets a range wider by a half on both sides; missing values are left out.
    """
    by = list(by)
    rows = df.select(*by, x).where(F.col(x).isNotNull())
    ends = rows.groupBy(*by).agg(F.min(x).cast("double").alias("_lo"), F.max(x).cast("double").alias("_hi"))
    flat = F.when(F.col("_lo") == F.col("_hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = ends.select(*by, (F.col("_lo") - flat).alias("_lo"), (F.col("_hi") + flat).alias("_hi"))
    lo, width = F.col("_lo"), (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.floor((F.col(x) - lo) / width), F.lit(bins - 1)).cast("int")
    counts = attach(rows, ends, by).groupBy(*by, "_lo", "_hi", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        *by, "bin", (lo + F.col("bin") * width).alias("left"), (lo + (F.col("bin") + 1) * width).alias("right"), "n"
    )


def histogram_prices(df: DataFrame, x: str = "price", bins: int = 50, exact: bool = True) -> DataFrame:
    """Histogram of 0 < x < 99 % point, with the mean and median of the kept rows."""
    top = quantile_values(df, x, {"q": 0.99}, exact)["q"]
    kept = df.where((F.col(x) > 0) & (F.col(x) < top))
    mid = quantile_values(kept, x, {"q": 0.5}, exact)["q"]
    mean = kept.agg(F.avg(x)).first()[0]
    return histogram(kept, x, bins).withColumns({"mean": F.lit(mean), "median": F.lit(mid)})


def boxplot_stats(df: DataFrame, by: str, x: str, exact: bool = True) -> DataFrame:
    """Quartiles, whiskers at the last point inside 1.5 spans, outlier count per group."""
    quart = quantiles(df, x, QUARTILES, [by], exact)
    # Equal values are counted first: copies of one quote do not travel one by one.
    counted = df.where(F.col(x).isNotNull()).groupBy(by, x).agg(F.count(F.lit(1)).alias("_n"))
    rows = attach(counted, quart, [by])
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col(x).between(F.col("q25") - reach, F.col("q75") + reach)
    return rows.groupBy(by, "q25", "q50", "q75").agg(
        F.min(F.when(inside, F.col(x))).alias("whisker_low"),
        F.max(F.when(inside, F.col(x))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_n"))).alias("n_outliers"), F.sum("_n").alias("n"),
    )


def trend_line(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Least-squares line of y on x."""
    return df.groupBy(*by).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept")
    )


# --- result tables -------------------------------------------------------------------------

def rank_models(results: DataFrame, metric: str = "rmse", ascending: bool = True, n: int | None = None) -> DataFrame:
    order = F.asc(metric) if ascending else F.desc(metric)
    ranked = results.orderBy(order, "model")
    return ranked.limit(n) if n else ranked


def rank_results(old: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Old and new result rows, best r2 first."""
    both = old.unionByName(new_rows, allowMissingColumns=True)
    return both.orderBy(F.desc("r2"), "model")


def _minmax(c: Column, lower_is_better: bool) -> Column:
    whole = Window.partitionBy()  # one row per model
    lo, hi = F.min(c).over(whole), F.max(c).over(whole)
    score = (c - lo) / (hi - lo + 1e-8)
    return 1 - score if lower_is_better else score


def heatmap_scores(results: DataFrame) -> DataFrame:
    out = {f"{m}_score": _minmax(F.col(m), True) for m in ("rmse", "mae", "mape")}
    out["r2_score"] = _minmax(F.col("r2"), False)
    return results.select("model", "rmse", "mae", "mape", "r2", *[c.alias(k) for k, c in out.items()])


def radar_scores(results: DataFrame) -> DataFrame:
    """Heat-map scores plus efficiency = r2 per million parameters, and size in millions."""
    millions = F.col("params") / 1e6
    rows = results.withColumns({"params_m": millions, "_eff": F.col("r2") / (millions + 0.1)})
    scores = {f"{m}_score": _minmax(F.col(m), True) for m in ("rmse", "mae", "mape")}
    scores["r2_score"] = _minmax(F.col("r2"), False)
    scores["efficiency"] = _minmax(F.col("_eff"), False)
    return rows.select("model", "params_m", *[c.alias(k) for k, c in scores.items()])


# --- chart tables of forecasts ---------------------------------------------------------------

def systematic_sample(df: DataFrame, idx: str, step: int) -> DataFrame:
    """Every step-th row along idx, from the first on."""
    return df.where(F.col(idx) % step == 0)


def error_by_quarter(df: DataFrame, by: Sequence[str], place: str = "place", parts: int = 4) -> DataFrame:
    """|error| in consecutive parts, cut before the rows n div 4, n div 2 and 3n div 4."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    cuts = [F.col(place) >= F.floor(F.col("_n") * i / parts) for i in range(1, parts)]
    part = sum((cut.cast("int") for cut in cuts), F.lit(1))
    rows = attach(df, sizes, by).withColumn("quarter", part)
    err = F.abs(F.col("y_true") - F.col("y_pred"))
    return rows.groupBy(*by, "quarter").agg(
        F.count(F.lit(1)).alias("n"), F.avg(err).alias("mean_abs_error"), F.max(err).alias("max_abs_error")
    )


def error_ecdf(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Sorted |error| against i/n, one row per forecast."""
    by = list(by)
    errs = df.select(*by, F.abs(F.col("y_true") - F.col("y_pred")).alias("abs_error"))
    rows = sorted_rows(value_positions(errs, by, "abs_error"))
    return rows.select(*by, "abs_error", "place", (F.col("place") / F.col("total")).alias("cumulative"))


def error_boxplot(df: DataFrame, by: str = "model", exact: bool = True) -> DataFrame:
    errs = df.select(by, (F.col("y_true") - F.col("y_pred")).alias("error"))
    return boxplot_stats(errs, by, "error", exact)


# Acklam's rational approximation of the inverse normal distribution.
PROBIT_A = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
PROBIT_B = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
PROBIT_C = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
PROBIT_D = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]


def inverse_normal(p: Column) -> Column:
    """Standard normal quantile as native arithmetic; relative error below 2e-9."""

    def poly(cs: list[float], x: Column) -> Column:
        out = F.lit(cs[0])
        for c in cs[1:]:
            out = out * x + c
        return out

    def tail(q: Column) -> Column:
        return poly(PROBIT_C, q) / poly(PROBIT_D, q)

    mid = p - 0.5
    inner = poly(PROBIT_A, mid * mid) * mid / poly(PROBIT_B, mid * mid)
    low = tail(F.sqrt(-2 * F.log(p)))
    high = -tail(F.sqrt(-2 * F.log(1 - p)))
    return F.when(p < 0.02425, low).when(p > 1 - 0.02425, high).otherwise(inner)


def qq_points(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Sorted residuals against normal quantiles at Filliben's plotting positions."""
    by = list(by)
    errs = df.select(*by, (F.col("y_true") - F.col("y_pred")).alias("residual"))
    rows = sorted_rows(value_positions(errs, by, "residual"))
    n, i = F.col("total").cast("double"), F.col("place")
    end = F.pow(F.lit(0.5), 1 / n)
    spot = F.when(i == 1, 1 - end).when(i == n, end).otherwise((i - 0.3175) / (n + 0.365))
    return rows.select(*by, "place", "residual", inverse_normal(spot).alias("quantile"))


def predictions_overlay(
    df: DataFrame, models: Sequence[str], keys: Sequence[str], idx: str = "idx", step: int = 1
) -> DataFrame:
    """Actual value and one column per model; every step-th row along idx, by default all."""
    rows = systematic_sample(df, idx, step)
    wide = rows.groupBy(*keys, idx).pivot("model", sorted(models)).agg(F.first("y_pred"))
    actual = rows.groupBy(*keys, idx).agg(F.first("y_true").alias("y_true"))
    return actual.join(wide, [*keys, idx])


def learning_curves(history: DataFrame) -> DataFrame:
    return history.select("model", "epoch", "loss", "val_loss").orderBy("model", "epoch")
