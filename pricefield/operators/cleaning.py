"""Filters, fences and encodings on raw quotes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import zero_if_not_finite
from ..functions.text import clean_name, is_farm_product
from .ordering import quantile_values


def filter_entity(
    df: DataFrame, commodity: str | None = None, state: str | None = None, market: str | None = None
) -> DataFrame:
    for name, value in (("commodity", commodity), ("state", state), ("market", market)):
        if value:
            df = df.where(clean_name(name) == value.lower().strip())
    return df


def filter_category(df: DataFrame, name: str = "commodity") -> DataFrame:
    return df.where(is_farm_product(name))


def excluded_categories(df: DataFrame, name: str = "commodity") -> DataFrame:
    return df.where(~is_farm_product(name)).select(clean_name(name).alias(name)).distinct()


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: zero_if_not_finite(c) for c in cols})


def fence_q01_q99(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Drop rows outside 1.5 spans of the 1 % and 99 % points, one column after the other.

    Every column's bounds come from the rows the former columns left. They are fetched as
    two numbers, so the next pass scans with literal filters.
    """
    for c in cols:
        q = quantile_values(df, c, {"lo": 0.01, "hi": 0.99}, exact)
        reach = 1.5 * (q["hi"] - q["lo"])
        df = df.where(F.col(c).between(q["lo"] - reach, q["hi"] + reach))
    return df


def fence_iqr(df: DataFrame, c: str = "price", exact: bool = True) -> DataFrame:
    """Tukey fence whose lower bound is not below zero."""
    q = quantile_values(df, c, {"lo": 0.25, "hi": 0.75}, exact)
    reach = 1.5 * (q["hi"] - q["lo"])
    return df.where(F.col(c).between(max(0.0, q["lo"] - reach), q["hi"] + reach))


def trim_quantiles(
    df: DataFrame, lo: float, hi: float, c: str = "price", positive: bool = False, exact: bool = True
) -> DataFrame:
    """Keep lo-quantile <= c <= hi-quantile; bounds are taken before the positive filter."""
    q = quantile_values(df, c, {"lo": lo, "hi": hi}, exact)
    df = df.where(F.col(c).between(q["lo"], q["hi"]))
    return df.where(F.col(c) > 0) if positive else df


def top_names(df: DataFrame, name: str, k: int) -> list[str]:
    """The k most frequent values (k is a small report size); ties by name."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), name).limit(k).collect()]


def flag_name(value: str) -> str:
    return "is_" + re.sub(r"[()]", "", value).replace(" ", "_").replace("-", "_")


def one_hot_topk(df: DataFrame, name: str, k: int = 20) -> DataFrame:
    flags: dict[str, Column] = {
        flag_name(v): F.when(F.col(name) == v, F.lit(1.0)).otherwise(F.lit(0.0)) for v in top_names(df, name, k)
    }
    return df.withColumns(flags) if flags else df


def semi_topk(df: DataFrame, name: str, k: int = 10) -> DataFrame:
    """Rows of the k most frequent names."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n"), name).limit(k).select(name)
    return df.join(F.broadcast(top), name, "left_semi")
