"""Price-shaped views over the test tables, each with the same definition in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.daily import daily_mean, gap_fill_linear
from ..operators.forecasters import baseline_forecasts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market quotes: many rows per commodity and day, three prices and a volume."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("p_name").alias("commodity"),
            F.col("n_name").alias("state"),
            F.col("s_name").alias("market"),
            F.col("l_extendedprice").alias("modal_price"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("min_price"),
            (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("max_price"),
            F.col("l_quantity").alias("arrivals"),
        )
    )


def prices_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified quotes with a unique row id."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("commodity"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_orderkey").alias("row_id"),
    )


def prices_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("price"),
        F.col("event_type").alias("commodity"),
        F.lit("events").alias("source"),
        F.col("event_id").alias("row_id"),
    )


def daily_commodity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_mean(prices_orders(spark, sf_dir), ["commodity"])


def daily_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per commodity and calendar day."""
    return gap_fill_linear(daily_commodity(spark, sf_dir), ["commodity"])


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, commodity, date, idx, y_true, y_pred) of three simple forecasters."""
    return baseline_forecasts(daily_filled(spark, sf_dir), ["commodity"])


SQL_VIEWS = {
    "prices_quotes": """
        SELECT CAST(l_shipdate AS DATE) AS date, p_name AS commodity, n_name AS state, s_name AS market,
               l_extendedprice AS modal_price, l_extendedprice * (1 - l_discount) AS min_price,
               l_extendedprice * (1 + l_tax) AS max_price, l_quantity AS arrivals
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey""",
    "prices_orders": """
        SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS price, o_orderpriority AS commodity,
               o_orderstatus AS source, o_orderkey AS row_id FROM orders""",
    "prices_events": """
        SELECT CAST(ts AS DATE) AS date, value AS price, event_type AS commodity, 'events' AS source,
               event_id AS row_id FROM events""",
    "daily_commodity": """
        SELECT commodity, date, avg(price) AS price FROM prices_orders GROUP BY commodity, date""",
    "daily_filled": """
        SELECT g.commodity, CAST(g.d AS DATE) AS date,
               g.price + CASE WHEN g.nxt IS NULL THEN 0 ELSE (g.nprice - g.price)
                 * CAST(date_diff('day', g.date, CAST(g.d AS DATE)) AS DOUBLE)
                 / CAST(date_diff('day', g.date, g.nxt) AS DOUBLE) END AS price
        FROM (SELECT *, unnest(generate_series(date, coalesce(nxt - 1, date), INTERVAL 1 DAY)) AS d
              FROM (SELECT commodity, date, price,
                           lead(date) OVER (PARTITION BY commodity ORDER BY date) AS nxt,
                           lead(price) OVER (PARTITION BY commodity ORDER BY date) AS nprice
                    FROM daily_commodity)) g""",
    "forecasts": """
        SELECT model, commodity, date, idx, y_true, y_pred FROM (
          SELECT commodity, date, price AS y_true, idx, unnest(['naive', 'seasonal_naive', 'sma_7']) AS model,
                 unnest([l1, l7, m7]) AS y_pred
          FROM (SELECT commodity, date, price,
                       row_number() OVER (PARTITION BY commodity ORDER BY date) - 1 AS idx,
                       lag(price, 1) OVER (PARTITION BY commodity ORDER BY date) AS l1,
                       lag(price, 7) OVER (PARTITION BY commodity ORDER BY date) AS l7,
                       avg(price) OVER (PARTITION BY commodity ORDER BY date
                                        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m7
                FROM daily_filled)) WHERE y_pred IS NOT NULL""",
}
