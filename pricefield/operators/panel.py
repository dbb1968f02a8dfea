"""Row-grain panel features.

A commodity may hold any share of all quotes, so frames run per (commodity, block of
rows) over a running row index, never over a whole commodity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import clip, zero_if_not_finite
from ..functions.calendar import cyclic_features
from ..functions.text import clean_name
from .cleaning import fence_iqr, filter_category, flag_name, top_names
from .joins import attach
from .ordering import BLOCK_ROWS, block_window, own_rows, series_index, with_blocks

PANEL_WINDOWS = [7, 14, 30]
PANEL_COLUMNS = [
    "date", "price", "price_log", "price_normalized", "log_return", "commodity_clean",
    "commodity_mean", "commodity_std", "ma_7", "ma_14", "ma_30", "std_7", "std_14", "std_30",
    "momentum", "day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos",
    "day_of_year_sin", "day_of_year_cos",
]
NOT_FEATURES = [
    "date", "price", "price_log", "price_normalized", "commodity_clean", "commodity_mean",
    "commodity_std", "log_return",
]


def group_stats(df: DataFrame, key: str, x: str = "price_log") -> DataFrame:
    """Mean and sample deviation per key; a zero deviation becomes 1."""
    stats = df.groupBy(key).agg(F.avg(x).alias("commodity_mean"), F.stddev_samp(x).alias("_s"))
    std = F.when(F.col("_s") == 0, F.lit(1.0)).otherwise(F.col("_s"))
    return stats.select(key, "commodity_mean", std.alias("commodity_std"))


def join_group_stats(df: DataFrame, key: str, x: str = "price_log") -> DataFrame:
    """Stats of each key onto its rows."""
    return attach(df, group_stats(df, key, x), [key], "left")


def zscore(df: DataFrame, x: str = "price_log") -> DataFrame:
    z = F.try_divide(F.col(x) - F.col("commodity_mean"), F.col("commodity_std"))
    return df.withColumn("price_normalized", clip(z, -5, 5))


def _on_blocks(df: DataFrame, key: str, tiebreak: str, back: int, build, block_rows: int) -> DataFrame:
    indexed = series_index(df, [key], "date", tiebreak, idx="_idx")
    blocks = with_blocks(indexed, "_idx", back, block_rows=block_rows)
    return own_rows(build(blocks, block_window([key], "_idx"))).drop("_idx")


def _return_column(w):
    step = F.col("price_log") - F.lag("price_log", 1).over(w)
    return clip(F.coalesce(step, F.lit(0.0)), -0.5, 0.5)


def log_return(df: DataFrame, key: str, tiebreak: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return _on_blocks(
        df, key, tiebreak, 1, lambda d, w: d.withColumn("log_return", _return_column(w)), block_rows
    )


def _rolling_columns(w, x: str, windows: Sequence[int]):
    out = {}
    for k in windows:
        frame = w.rowsBetween(-(k - 1), 0)
        out[f"ma_{k}"] = F.avg(x).over(frame)
        out[f"std_{k}"] = F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0))
    return out


def panel_rolling(
    df: DataFrame, key: str, tiebreak: str, x: str = "price_normalized",
    windows: Sequence[int] = PANEL_WINDOWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return _on_blocks(
        df, key, tiebreak, max(windows) - 1,
        lambda d, w: d.withColumns(_rolling_columns(w, x, windows)), block_rows,
    )


def panel_features(df: DataFrame, key: str, tiebreak: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Returns, rolling statistics, momentum and calendar cycles in one indexed pass."""

    def build(d: DataFrame, w) -> DataFrame:
        return d.withColumns({
            "log_return": _return_column(w),
            **_rolling_columns(w, "price_normalized", PANEL_WINDOWS),
        })

    rows = _on_blocks(df, key, tiebreak, max(PANEL_WINDOWS) - 1, build, block_rows)
    return rows.withColumns({
        "momentum": F.col("price_normalized") - F.col("ma_7"), **cyclic_features("date"),
    })


def processed_panel(
    df: DataFrame, tiebreak: str, top: int = 20, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Unified quotes to the processed panel: filter, fence, scale, features, one-hots."""
    rows = df.na.drop(subset=["date", "price"]).withColumn("commodity_clean", clean_name("commodity"))
    rows = fence_iqr(filter_category(rows, "commodity_clean"))
    names = top_names(rows, "commodity_clean", top)
    rows = rows.select("date", "price", "commodity_clean", tiebreak)
    rows = rows.withColumn("price_log", F.log1p("price"))
    rows = zscore(join_group_stats(rows, "commodity_clean"))
    rows = panel_features(rows, "commodity_clean", tiebreak, block_rows)
    flags = [
        F.when(F.col("commodity_clean") == n, F.lit(1.0)).otherwise(F.lit(0.0)).alias(flag_name(n))
        for n in names
    ]
    fixed = [
        zero_if_not_finite(c).alias(c) if c not in ("date", "commodity_clean") else F.col(c)
        for c in PANEL_COLUMNS
    ]
    return rows.select(*fixed, *flags, tiebreak)
