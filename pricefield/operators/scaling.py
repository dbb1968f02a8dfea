"""Column scalers. Fitting fetches one row of statistics; scaling is then a projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import quantile_values


Stats = dict[str, tuple[Column, Column]]


def _fit(df: DataFrame, aggs: dict[str, Column], fit_on: Column | None) -> dict[str, float]:
    rows = df if fit_on is None else df.where(fit_on)
    return rows.agg(*[c.alias(k) for k, c in aggs.items()]).first().asDict()


def _pair(shift: float | None, size: float | None) -> tuple[Column, Column]:
    return F.lit(shift).cast("double"), F.lit(size or 1.0).cast("double")


def minmax_stats(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> Stats:
    """(shift, scale) per column; a constant column is scaled by 1."""
    ends = _fit(df, {f"{f}_{c}": g(c) for c in cols for f, g in (("lo", F.min), ("hi", F.max))}, fit_on)
    return {c: _pair(ends[f"lo_{c}"], (ends[f"hi_{c}"] or 0) - (ends[f"lo_{c}"] or 0)) for c in cols}


def standard_stats(df: DataFrame, cols: Sequence[str], fit_on: Column | None = None) -> Stats:
    """Mean and population deviation."""
    fit = _fit(df, {f"{f}_{c}": g(c) for c in cols for f, g in (("mean", F.avg), ("std", F.stddev_pop))}, fit_on)
    return {c: _pair(fit[f"mean_{c}"], fit[f"std_{c}"]) for c in cols}


def robust_stats(
    df: DataFrame, cols: Sequence[str], fit_on: Column | None = None, exact: bool = True
) -> Stats:
    """Median and quartile span."""
    rows = df if fit_on is None else df.where(fit_on)
    out = {}
    for c in cols:
        q = quantile_values(rows, c, {"lo": 0.25, "mid": 0.5, "hi": 0.75}, exact)
        out[c] = _pair(q["mid"], q["hi"] - q["lo"])
    return out


SCALERS = {"minmax": minmax_stats, "standard": standard_stats, "robust": robust_stats}


def scale(df: DataFrame, cols: Sequence[str], method: str = "minmax", fit_on: Column | None = None) -> DataFrame:
    """Scale columns in place. fit_on limits the rows the statistics come from."""
    stats = SCALERS[method](df, cols, fit_on)
    return df.withColumns({c: (F.col(c) - shift) / size for c, (shift, size) in stats.items()})


def unscale(x: Column | str, shift: Column, size: Column) -> Column:
    return (F.col(x) if isinstance(x, str) else x) * size + shift
