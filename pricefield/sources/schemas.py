"""Declared schemas and column lookup by name fragment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE_COLUMNS = ["date", "price", "commodity", "source"]


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


MANDI = text_schema(
    "State", "Market", "Commodity", "Arrival_Date", "Min Price", "Max Price", "Modal Price"
)
QUOTES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("commodity", T.StringType()),
    T.StructField("source", T.StringType()),
])
DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("n_records", T.LongType()),
])
RESULTS = T.StructType([
    T.StructField("model", T.StringType()),
    *[
        T.StructField(n, T.DoubleType())
        for n in ("rmse", "mae", "mape", "r2", "directional_acc", "ic", "ic_pvalue")
    ],
    T.StructField("params", T.LongType()),
    T.StructField("epochs", T.LongType()),
])
HISTORY = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("epoch", T.IntegerType()),
    *[T.StructField(n, T.DoubleType()) for n in ("loss", "val_loss", "mae", "val_mae")],
])


def header_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalize_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def rename_escaped(df: DataFrame) -> DataFrame:
    """`min_x0020_price` (an XML-escaped blank) becomes `min_price`."""
    return df.withColumnsRenamed({c: c.replace("_x0020_", "_") for c in df.columns if "_x0020_" in c})


def find_column(names: Sequence[str], *fragments: str) -> str | None:
    """First name that holds any of the fragments."""
    return next((n for n in names if any(f in n.lower() for f in fragments)), None)


def column_or(df: DataFrame, default: str, *fragments: str) -> Column:
    name = find_column(df.columns, *fragments)
    return F.col(f"`{name}`") if name else F.lit(default)


def date_column(names: Sequence[str]) -> str | None:
    return next((n for n in ("arrival_date", "date", "price_date") if n in names), None)


def numeric_features(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    kinds = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]
