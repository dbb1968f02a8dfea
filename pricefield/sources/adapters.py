"""Each raw layout to the unified quote table (date, price, commodity, source)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import number
from ..functions.text import date_from_parts, lenient_date, strict_date
from .schemas import QUOTE_COLUMNS, column_or, date_column, find_column, normalize_header


def _name(df: DataFrame, default: str, *fragments: str, trim: bool = False) -> Column:
    c = F.lower(column_or(df, default, *fragments))
    return F.trim(c) if trim else c


def _quotes(df: DataFrame, date: Column, price: Column, commodity: Column, source: str) -> DataFrame:
    return df.select(
        date.alias("date"), number(price).alias("price"), commodity.alias("commodity"),
        F.lit(source).alias("source"),
    ).na.drop()


def _required(df: DataFrame, *fragments: str) -> Column:
    name = find_column(df.columns, *fragments)
    if name is None:
        raise ValueError(f"no column like {fragments} in {df.columns}")
    return F.col(f"`{name}`")


def mandi(df: DataFrame, source: str = "agriculture_india", trim: bool = False) -> DataFrame:
    d = normalize_header(df)
    when = strict_date(d[date_column(d.columns)])
    return _quotes(d, when, d["modal_price"], _name(d, "agriculture", "commodity", trim=trim), source)


def wfp_india(df: DataFrame, source: str = "india_wfp") -> DataFrame:
    """Tag rows (first cell starts with '#') are dropped wherever they stand."""
    d = normalize_header(df)
    first = d[d.columns[0]]
    d = d.where(first.isNull() | ~first.startswith("#"))
    return _quotes(
        d, lenient_date(_required(d, "date")), _required(d, "price"),
        _name(d, "food", "commodity", "item"), source,
    )


def kalimati(df: DataFrame, source: str = "kalimati_nepal") -> DataFrame:
    d = normalize_header(df)
    return _quotes(
        d, lenient_date(_required(d, "date")), _required(d, "average", "price"),
        _name(d, "vegetable", "commodity", "item", "product"), source,
    )


def wfp_global(df: DataFrame, source: str = "wfp_global") -> DataFrame:
    """Mid-month date from year and month; a date column is used where there are no parts."""
    d = normalize_header(df)
    if "mp_year" in d.columns:
        when = date_from_parts("mp_year", "mp_month", 15)
    else:
        when = lenient_date(_required(d, "date"))
    return _quotes(d, when, _required(d, "price"), _name(d, "food", "cm_name", "commodity"), source)


def wide_futures(
    df: DataFrame, source: str = "commodity_futures", commodities: Sequence[str] | None = None, lower: bool = True
) -> DataFrame:
    """One column per commodity to one row per quote; all columns beside the date, or the named ones."""
    date = find_column(df.columns, "date")
    cols = [c for c in df.columns if c != date] if commodities is None else list(commodities)
    long = df.select(lenient_date(F.col(date).cast("string")).alias("date"), *[number(c).alias(c) for c in cols])
    long = long.unpivot("date", cols, "commodity", "price")
    name = F.lower("commodity") if lower else F.col("commodity")
    return _quotes(long, F.col("date"), F.col("price"), name, source)


def long_futures(df: DataFrame, source: str = "commodity_futures") -> DataFrame:
    d = normalize_header(df)
    return _quotes(
        d, lenient_date(_required(d, "date")), _required(d, "close", "price"),
        _name(d, "commodity", "name", "symbol"), source,
    )


def crop_yearly(df: DataFrame, source: str = "crop_prediction") -> DataFrame:
    d = normalize_header(df)
    year = date_from_parts(_required(d, "year"), 1, 1)
    return _quotes(d, year, _required(d, "price", "production"), _name(d, "crop", "crop", "item"), source)


ADAPTERS = {
    "mandi": mandi,
    "wfp_india": wfp_india,
    "kalimati": kalimati,
    "wfp_global": wfp_global,
    "wide_futures": wide_futures,
    "long_futures": long_futures,
    "crop_yearly": crop_yearly,
}


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Union of all unified sources; `priority` is the position in the list."""
    tagged = [s.select(*QUOTE_COLUMNS).withColumn("priority", F.lit(i)) for i, s in enumerate(sources)]
    return reduce(DataFrame.unionByName, tagged)


def dedup_quotes(union: DataFrame) -> DataFrame:
    """One row per (date, price, commodity); the earliest source in the list wins."""
    return (
        union.groupBy("date", "price", "commodity")
        .agg(F.min_by("source", "priority").alias("source"))
        .select(*QUOTE_COLUMNS)
    )
