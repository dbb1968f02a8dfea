"""Cleaning, joins and day-grain series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arithmetic import clip, div_inf
from ..functions.calendar import calendar_features, cyclic_features, month_indices
from ..functions.text import clean_name, lenient_date
from ..operators import cleaning, daily, ensemble, panel
from ..operators.ordering import fill_rows, series_index
from ..sources.views import daily_commodity, daily_filled, forecasts, prices_events, prices_orders, prices_quotes
from .registry import query, r, rounded, s, single


def named_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes whose hot and cold goods carry names the category filter cares about."""
    name = (
        F.when(F.col("commodity").startswith("hot"), F.concat(F.lit("Watermelon "), "commodity"))
        .when(F.col("commodity").startswith("cold"), F.concat(F.lit(" Exchange Rate "), "commodity"))
        .otherwise(F.col("commodity"))
    )
    return prices_quotes(spark, sf_dir).select("date", name.alias("commodity"), F.col("modal_price").alias("price"))


NAMED_SQL = """
    SELECT date, CASE WHEN commodity LIKE 'hot%' THEN 'Watermelon ' || commodity
                      WHEN commodity LIKE 'cold%' THEN ' Exchange Rate ' || commodity ELSE commodity END AS commodity,
           modal_price AS price FROM prices_quotes"""
WORDS = ("wage", "fuel", "diesel", "petrol", "gasoline", "kerosene", "exchange", "rate", "transport", "rent",
         "labour", "labor", "charcoal", "firewood", "electricity", "water")
HAS_WORD = " OR ".join(f"lower(commodity) LIKE '%{w}%'" for w in WORDS)


def gappy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with some prices missing, the first rows among them."""
    gap = (F.col("row_id") % 7 == 0) | (F.col("date") < F.lit("1995-01-03").cast("date"))
    return prices_orders(spark, sf_dir).withColumn("price", F.when(~gap, F.col("price")))


GAPPY_SQL = """
    SELECT date, CASE WHEN NOT (row_id % 7 = 0 OR date < DATE '1995-01-03') THEN price END AS price, commodity,
           source, row_id FROM prices_orders"""


@query("parse_date_lenient", "SELECT row_id, date FROM prices_orders")
def _(spark, d):
    text = (
        F.when(F.col("row_id") % 3 == 0, F.date_format("date", "M/d/yyyy"))
        .when(F.col("row_id") % 3 == 1, F.date_format("date", "MMM d, yyyy"))
        .otherwise(F.col("date").cast("string"))
    )
    return prices_orders(spark, d).select("row_id", lenient_date(text).alias("date"))


@query("filter_entity", """
    SELECT date, commodity, state, market, modal_price FROM prices_quotes
    WHERE lower(commodity) = 'red plate' AND lower(state) = 'nation_3'""")
def _(spark, d):
    rows = cleaning.filter_entity(prices_quotes(spark, d), commodity=" Red Plate", state="NATION_3 ")
    return rows.select("date", "commodity", "state", "market", "modal_price")


@query("drop_nulls", f"SELECT * FROM ({GAPPY_SQL}) WHERE price IS NOT NULL")
def _(spark, d):
    return gappy_orders(spark, d).na.drop(subset=["date", "price"])


@query("filter_category", f"SELECT date, commodity, price FROM ({NAMED_SQL}) WHERE NOT ({HAS_WORD})")
def _(spark, d):
    return cleaning.filter_category(named_quotes(spark, d))


@query("excluded_categories", f"""
    SELECT DISTINCT lower(trim(commodity)) AS commodity FROM ({NAMED_SQL}) WHERE {HAS_WORD}""")
def _(spark, d):
    return cleaning.excluded_categories(named_quotes(spark, d))


@query("ffill_bfill", f"""
    WITH days AS (SELECT commodity, date, avg(price) AS price FROM ({GAPPY_SQL}) GROUP BY commodity, date)
    SELECT commodity, date, {s('''coalesce(
        last_value(price IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY date),
        first_value(price IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY date
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))''', 'price')} FROM days""")
def _(spark, d):
    days = daily.daily_mean(gappy_orders(spark, d), ["commodity"])
    return single(daily.fill_daily(days, ["commodity"], ["price"]))


@query("ffill_bfill_rows", f"""
    SELECT row_id, date, commodity, coalesce(
        last_value(price IGNORE NULLS) OVER (ORDER BY date, row_id ROWS UNBOUNDED PRECEDING),
        first_value(price IGNORE NULLS) OVER (ORDER BY date, row_id
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM ({GAPPY_SQL})""")
def _(spark, d):
    rows = series_index(gappy_orders(spark, d), [], "date", "row_id")
    return fill_rows(rows, [], "idx", ["price"]).select("row_id", "date", "commodity", "price")


@query("inf_nan_to_zero", f"""
    SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 0 ELSE {r('price / (row_id % 5)', 6, 'x').rsplit(' AS ', 1)[0]} END AS x
    FROM prices_orders""")
def _(spark, d):
    rows = prices_orders(spark, d).select("row_id", div_inf(F.col("price"), F.col("row_id") % 5).alias("x"))
    return rounded(cleaning.zero_fill(rows, ["x"]), 6)


@query("clip_values", """
    SELECT row_id, CASE WHEN price IS NOT NULL THEN least(greatest(price, 50000.0::DOUBLE), 250000.0::DOUBLE) END AS price
    FROM (SELECT row_id, CASE WHEN NOT (row_id % 7 = 0 OR date < DATE '1995-01-03') THEN price END AS price
          FROM prices_orders)""")
def _(spark, d):
    return gappy_orders(spark, d).select("row_id", clip("price", 50_000, 250_000).alias("price"))


@query("log_price", f"SELECT row_id, {r('ln(1 + price)', 8, 'price_log')} FROM prices_orders")
def _(spark, d):
    return rounded(prices_orders(spark, d).select("row_id", F.log1p("price").alias("price_log")), 8)


@query("one_hot_topk", """
    SELECT row_id, commodity, CAST(commodity = '1-URGENT' AS DOUBLE) AS "is_1_URGENT",
           CAST(commodity = '2-HIGH' AS DOUBLE) AS "is_2_HIGH", CAST(commodity = '3-MEDIUM' AS DOUBLE) AS "is_3_MEDIUM",
           CAST(commodity = '4-NOT SPECIFIED' AS DOUBLE) AS "is_4_NOT_SPECIFIED",
           CAST(commodity = '5-LOW' AS DOUBLE) AS "is_5_LOW" FROM prices_orders""")
def _(spark, d):
    rows = prices_orders(spark, d).select("row_id", "commodity")
    hot = cleaning.one_hot_topk(rows, "commodity", 20)
    return hot.select("row_id", "commodity", *sorted(c for c in hot.columns if c.startswith("is_")))


def _fence_sql(src: str, cols: list[str]) -> tuple[str, str]:
    ctes, last = [], src
    for i, c in enumerate(cols):
        ctes.append(f"""f{i} AS (SELECT t.* FROM {last} t, (SELECT quantile_cont({c}, 0.01) AS a,
            quantile_cont({c}, 0.99) AS b FROM {last}) q
            WHERE {c} BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a))""")
        last = f"f{i}"
    return ",\n".join(ctes), last


SPIKED = """SELECT date, commodity, CASE WHEN arrivals > 49 THEN min_price * 40 ELSE min_price END AS min_price,
                   max_price, CASE WHEN arrivals < 2 THEN modal_price * 60 ELSE modal_price END AS modal_price
            FROM prices_quotes"""
_FENCES, _LAST = _fence_sql("spiked", ["min_price", "max_price", "modal_price"])


@query("fence_q01_q99", f"""
    WITH spiked AS ({SPIKED}), {_FENCES}
    SELECT date, commodity, {r('min_price', 4)}, {r('max_price', 4)}, {r('modal_price', 4)} FROM {_LAST}""")
def _(spark, d):
    spiked = prices_quotes(spark, d).select(
        "date", "commodity",
        F.when(F.col("arrivals") > 49, F.col("min_price") * 40).otherwise(F.col("min_price")).alias("min_price"),
        "max_price",
        F.when(F.col("arrivals") < 2, F.col("modal_price") * 60).otherwise(F.col("modal_price")).alias("modal_price"),
    )
    return rounded(cleaning.fence_q01_q99(spiked, ["min_price", "max_price", "modal_price"]), 4)


@query("fence_iqr", """
    SELECT t.* FROM prices_orders t, (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b
                                      FROM prices_orders) q
    WHERE price >= greatest(0, a - 1.5 * (b - a)) AND price <= b + 1.5 * (b - a)""")
def _(spark, d):
    return cleaning.fence_iqr(prices_orders(spark, d))


@query("trim_q01_q99", """
    SELECT t.* FROM prices_orders t, (SELECT quantile_cont(price, 0.01) AS a, quantile_cont(price, 0.99) AS b
                                      FROM prices_orders) q WHERE price >= a AND price <= b""")
def _(spark, d):
    return cleaning.trim_quantiles(prices_orders(spark, d), 0.01, 0.99)


@query("trim_q005_q995", """
    SELECT t.* FROM prices_events t, (SELECT quantile_cont(price, 0.005) AS a, quantile_cont(price, 0.995) AS b
                                      FROM prices_events) q WHERE price > 0 AND price >= a AND price <= b""")
def _(spark, d):
    return cleaning.trim_quantiles(prices_events(spark, d), 0.005, 0.995, positive=True)


@query("month_index_map", """
    SELECT row_id, CAST(list_extract([0.3, 0.35, 0.5, 0.7, 0.85, 0.95, 1.0, 0.95, 0.8, 0.5, 0.35, 0.3], month(date)) AS DOUBLE) AS weather_index,
           CAST(list_extract([0.3, 0.4, 0.6, 0.8, 0.95, 0.9, 0.75, 0.7, 0.65, 0.5, 0.35, 0.3], month(date)) AS DOUBLE) AS temp_index
    FROM prices_orders""")
def _(spark, d):
    return prices_orders(spark, d).select("row_id", *[c.alias(k) for k, c in month_indices("date").items()])


@query("distinct_values", """
    SELECT DISTINCT commodity, source FROM prices_orders UNION SELECT DISTINCT commodity, source FROM prices_events""")
def _(spark, d):
    return prices_orders(spark, d).unionByName(prices_events(spark, d)).select("commodity", "source").distinct()


@query("calendar_features", f"""
    SELECT DISTINCT date, CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month,
      CAST(dayofyear(date) AS INT) AS day_of_year, CAST(weekofyear(date) AS INT) AS week_of_year,
      CAST(month(date) AS INT) AS month, CAST(quarter(date) AS INT) AS quarter, CAST(year(date) AS INT) AS year,
      CAST(isodow(date) >= 6 AS INT) AS is_weekend, CAST(day(date) = 1 AS INT) AS is_month_start,
      CAST(date = last_day(date) AS INT) AS is_month_end,
      CAST(day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS INT) AS is_quarter_start,
      CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS INT) AS is_quarter_end,
      CAST(month(date) BETWEEN 6 AND 10 AS INT) AS season_kharif,
      CAST(month(date) IN (11, 12, 1, 2, 3) AS INT) AS season_rabi, CAST(month(date) IN (4, 5) AS INT) AS season_zaid,
      CAST(month(date) IN (10, 11) AS INT) AS is_festival_season,
      {r('sin(2 * pi() * month(date) / 12)', 9, 'month_sin')}, {r('cos(2 * pi() * month(date) / 12)', 9, 'month_cos')},
      {r('sin(2 * pi() * (isodow(date) - 1) / 7)', 9, 'day_of_week_sin')},
      {r('cos(2 * pi() * (isodow(date) - 1) / 7)', 9, 'day_of_week_cos')},
      {r('sin(2 * pi() * dayofyear(date) / 365)', 9, 'day_of_year_sin')},
      {r('cos(2 * pi() * dayofyear(date) / 365)', 9, 'day_of_year_cos')}
    FROM prices_orders""")
def _(spark, d):
    days = prices_orders(spark, d).select("date").distinct()
    return rounded(days.withColumns(calendar_features()), 9)


@query("calendar_cyclic", f"""
    SELECT row_id, {r('sin(2 * pi() * month(date) / 12)', 9, 'month_sin')},
      {r('cos(2 * pi() * month(date) / 12)', 9, 'month_cos')},
      {r('sin(2 * pi() * (isodow(date) - 1) / 7)', 9, 'day_of_week_sin')},
      {r('cos(2 * pi() * (isodow(date) - 1) / 7)', 9, 'day_of_week_cos')},
      {r('sin(2 * pi() * dayofyear(date) / 365)', 9, 'day_of_year_sin')},
      {r('cos(2 * pi() * dayofyear(date) / 365)', 9, 'day_of_year_cos')} FROM prices_events""")
def _(spark, d):
    rows = prices_events(spark, d)
    return rounded(rows.select("row_id", *[c.alias(k) for k, c in cyclic_features("date").items()]), 9)


# --- joins -----------------------------------------------------------------------------

def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices_orders(spark, sf_dir).select(
        "row_id", "date", "price", clean_name("commodity").alias("commodity_clean"), F.log1p("price").alias("price_log")
    )


@query("join_group_stats", f"""
    SELECT row_id, lower(o.commodity) AS commodity_clean, {r('m', 8, 'commodity_mean')}, {r('s', 8, 'commodity_std')}
    FROM prices_orders o LEFT JOIN (SELECT commodity, avg(ln(1 + price)) AS m,
      CASE WHEN stddev_samp(ln(1 + price)) = 0 THEN 1 ELSE stddev_samp(ln(1 + price)) END AS s
      FROM prices_orders GROUP BY commodity) g ON o.commodity = g.commodity""")
def _(spark, d):
    rows = panel.join_group_stats(logged(spark, d), "commodity_clean")
    return rounded(rows.select("row_id", "commodity_clean", "commodity_mean", "commodity_std"), 8)


@query("date_spine", f"""
    SELECT s.commodity, s.date, {r('p.price', 6, 'price')} FROM (
      SELECT commodity, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
      FROM daily_commodity GROUP BY commodity) s
    LEFT JOIN daily_commodity p ON p.commodity = s.commodity AND p.date = s.date""")
def _(spark, d):
    return rounded(daily.date_spine(daily_commodity(spark, d), ["commodity"]), 6)


@query("gap_fill_linear", f"SELECT commodity, date, {s('price')} FROM daily_filled")
def _(spark, d):
    return single(daily_filled(spark, d))


@query("semi_topk", """
    SELECT date, commodity, state, market, modal_price FROM prices_quotes WHERE commodity IN (
      SELECT commodity FROM prices_quotes GROUP BY commodity ORDER BY count(*) DESC, commodity LIMIT 10)""")
def _(spark, d):
    rows = cleaning.semi_topk(prices_quotes(spark, d), "commodity", 10)
    return rows.select("date", "commodity", "state", "market", "modal_price")


@query("stack_predictions", f"""
    SELECT commodity, idx, {s("max(CASE WHEN model = 'naive' THEN y_pred END)", 'naive')},
      {s("max(CASE WHEN model = 'seasonal_naive' THEN y_pred END)", 'seasonal_naive')},
      {s("max(CASE WHEN model = 'sma_7' THEN y_pred END)", 'sma_7')}
    FROM forecasts GROUP BY commodity, idx""")
def _(spark, d):
    models = ["naive", "seasonal_naive", "sma_7"]
    return single(ensemble.stack_predictions(forecasts(spark, d), models, ["commodity", "idx"]))
