"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.views import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the SQL with the views it names, and the views those name."""
    views = {**SQL_VIEWS, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name in text and name not in needed:
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in needed)
    body = body.strip()
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{ctes},\n{body[len(head):]}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int, cols: Sequence[str] | None = None) -> DataFrame:
    """Round floats on output; adding 0.0 turns -0.0 into 0.0."""
    names = cols if cols is not None else [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def r(expr: str, digits: int, alias: str | None = None) -> str:
    """The SQL form of `rounded`."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS {alias or expr}"


def single(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Report doubles at single precision: sums differ in their last bits by addition order."""
    names = cols if cols is not None else [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in names})


def s(expr: str, alias: str | None = None) -> str:
    """The SQL form of `single`."""
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE) AS {alias or expr}"


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounded, then single precision: for tables that mix tiny and large values."""
    return single(rounded(df, digits))


def t(expr: str, alias: str, digits: int = 6) -> str:
    """The SQL form of `tidy`."""
    return f"CAST(CAST(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE) AS FLOAT) AS DOUBLE) AS {alias}"
