"""Day-grain series: aggregation, calendar spine, gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import quantiles


def daily_mean(df: DataFrame, series: Sequence[str], price: str = "price", date: str = "date") -> DataFrame:
    return df.groupBy(*series, date).agg(F.avg(price).alias(price))


def daily_median(
    df: DataFrame, series: Sequence[str], price: str = "price", date: str = "date", exact: bool = True
) -> DataFrame:
    return quantiles(df, price, {price: 0.5}, [*series, date], exact)


def daily_weighted(
    df: DataFrame, series: Sequence[str], price: str = "price", volume: str = "arrivals", date: str = "date"
) -> DataFrame:
    """Mean weighted by volume + 1 over the rows that have a price; the plain mean when there is no volume column."""
    if volume not in df.columns:
        return daily_mean(df, series, price, date)
    weight = F.when(F.col(price).isNotNull(), F.col(volume) + 1)
    mean = F.try_divide(F.sum(F.col(price) * weight), F.sum(weight))
    return df.groupBy(*series, date).agg(mean.alias(price))


DAILY_METHODS = {"mean": daily_mean, "median": daily_median, "weighted": daily_weighted}


def aggregate_daily(df: DataFrame, series: Sequence[str], price: str = "price", method: str = "mean") -> DataFrame:
    if method not in DAILY_METHODS:
        raise ValueError(f"unknown aggregation method: {method}")
    return DAILY_METHODS[method](df, series, price)


def daily_mean_count(df: DataFrame, series: Sequence[str], price: str = "price", date: str = "date") -> DataFrame:
    return df.groupBy(*series, date).agg(F.avg(price).alias(price), F.count(F.lit(1)).alias("n_records"))


def _to_next_day(df: DataFrame, series: Sequence[str], value: str, date: str) -> DataFrame:
    """One row per calendar day up to the day before the next observation, plus its values."""
    w = Window.partitionBy(*series).orderBy(date)
    spans = df.select(
        *series, date, value, F.lead(date).over(w).alias("_nd"), F.lead(value).over(w).alias("_nv")
    )
    until = F.coalesce(F.date_sub("_nd", 1), F.col(date))
    return spans.withColumn("_day", F.explode(F.sequence(F.col(date), until)))


def date_spine(df: DataFrame, series: Sequence[str], value: str = "price", date: str = "date") -> DataFrame:
    """Every day between the first and last of a series; NULL where nothing was observed.

    Each observation emits the days up to the next one, so no spine has to be joined.
    """
    days = _to_next_day(df, series, value, date)
    seen = F.when(F.col("_day") == F.col(date), F.col(value))
    return days.select(*series, F.col("_day").alias(date), seen.alias(value))


def gap_fill_linear(df: DataFrame, series: Sequence[str], value: str = "price", date: str = "date") -> DataFrame:
    """Calendar spine with straight lines between neighbouring observations."""
    days = _to_next_day(df.where(F.col(value).isNotNull()), series, value, date)
    done = F.datediff("_day", date).cast("double")
    span = F.datediff("_nd", date).cast("double")
    step = F.coalesce((F.col("_nv") - F.col(value)) * done / span, F.lit(0.0))
    return days.select(*series, F.col("_day").alias(date), (F.col(value) + step).alias(value))


def fill_daily(
    df: DataFrame, series: Sequence[str], cols: Sequence[str], date: str = "date", strict: bool = False
) -> DataFrame:
    """Forward fill, then (unless strict) fill leading gaps with the first later value."""
    keys = ", ".join(f"`{k}`" for k in series)
    part = f"PARTITION BY {keys} " if keys else ""

    def known(c: str, order: str) -> str:
        frame = f"{part}ORDER BY `{date}` {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        return f"last_value(`{c}`) IGNORE NULLS OVER ({frame})"

    # Later values come from a running frame in falling order; the frame from the current row
    # to the end of the series would be scanned again for every row.
    orders = ["ASC"] if strict else ["ASC", "DESC"]
    return df.withColumns({c: F.expr(f"coalesce({', '.join(known(c, o) for o in orders)})") for c in cols})


def future_frame(
    df: DataFrame, series: Sequence[str], periods: int, include_history: bool = False, date: str = "date"
) -> DataFrame:
    """The next `periods` days of every series, optionally after its own days."""
    ends = df.groupBy(*series).agg(F.max(date).alias("_end"), F.min(date).alias("_begin"))
    first = F.col("_begin") if include_history else F.date_add("_end", 1)
    days = F.sequence(first, F.date_add("_end", periods))
    return ends.select(*series, F.explode(days).alias(date))
