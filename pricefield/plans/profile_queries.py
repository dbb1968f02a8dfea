"""Aggregations, profiles and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import daily, panel, profile
from ..operators.ordering import series_index
from ..sources.views import daily_filled, forecasts, prices_events, prices_orders, prices_quotes
from .clean_queries import GAPPY_SQL, gappy_orders, logged
from .registry import query, r, rounded, s, single


@query("daily_mean", f"""
    SELECT commodity, date, {s('avg(modal_price)', 'modal_price')} FROM prices_quotes GROUP BY commodity, date""")
def _(spark, d):
    return single(daily.daily_mean(prices_quotes(spark, d), ["commodity"], "modal_price"))


@query("daily_median", f"""
    SELECT commodity, date, {s('quantile_cont(modal_price, 0.5)', 'modal_price')}
    FROM prices_quotes GROUP BY commodity, date""")
def _(spark, d):
    return single(daily.aggregate_daily(prices_quotes(spark, d), ["commodity"], "modal_price", "median"))


@query("daily_weighted", f"""
    SELECT commodity, date, {s('sum(modal_price * (arrivals + 1)) / sum(arrivals + 1)', 'modal_price')}
    FROM prices_quotes GROUP BY commodity, date""")
def _(spark, d):
    return single(daily.aggregate_daily(prices_quotes(spark, d), ["commodity"], "modal_price", "weighted"))


@query("daily_mean_count", f"""
    SELECT date, {s('avg(price)', 'price')}, count(*) AS n_records FROM prices_orders GROUP BY date""")
def _(spark, d):
    return single(daily.daily_mean_count(prices_orders(spark, d), []))


@query("group_stats", f"""
    SELECT lower(commodity) AS commodity_clean, {r('avg(ln(1 + price))', 8, 'commodity_mean')},
      {r('CASE WHEN stddev_samp(ln(1 + price)) = 0 THEN 1 ELSE stddev_samp(ln(1 + price)) END', 8, 'commodity_std')}
    FROM prices_orders GROUP BY 1""")
def _(spark, d):
    return rounded(panel.group_stats(logged(spark, d), "commodity_clean"), 8)


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM prices_quotes"
    for c in ("commodity", "state", "market")))
def _(spark, d):
    return profile.distinct_counts(prices_quotes(spark, d), ["commodity", "state", "market"])


SKETCHED = ("row_id", "price", "date", "commodity")


@query("distinct_counts_merged", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, TRUE AS near FROM prices_orders" for c in SKETCHED))
def _(spark, d):
    """Daily sketches merged over all days, held against the exact counts: four standard errors at most."""
    rows = prices_orders(spark, d)
    exact = profile.distinct_counts(rows, SKETCHED)
    merged = profile.merged_distinct_counts(profile.distinct_sketches(rows, ["date"], SKETCHED), SKETCHED)
    both = exact.join(merged.withColumnRenamed("n_unique", "estimate"), "column")
    off = F.abs(F.col("estimate") - F.col("n_unique"))
    return both.select("column", "n_unique", (off <= F.greatest(F.lit(1.0), 0.0325 * F.col("n_unique"))).alias("near"))


@query("top_values", """
    SELECT commodity, count(*) AS n FROM prices_quotes GROUP BY commodity ORDER BY n DESC, commodity LIMIT 20""")
def _(spark, d):
    return profile.top_values(prices_quotes(spark, d), "commodity", 20)


@query("topk_share", f"""
    WITH top AS (SELECT state, count(*) AS n FROM prices_quotes GROUP BY state ORDER BY n DESC, state LIMIT 5)
    SELECT state, n, {s('n * 100.0 / sum(n) OVER ()', 'share')} FROM top""")
def _(spark, d):
    return single(profile.topk_share(prices_quotes(spark, d), "state", 5))


@query("describe_prices", " UNION ALL ".join(f"""
    SELECT '{c}' AS "column", count({c}) AS count, {s(f'avg({c})', 'mean')}, {s(f'stddev_samp({c})', 'std')},
      {s(f'min({c})', 'min')}, {s(f'max({c})', 'max')}, {s(f'quantile_cont({c}, 0.25)', 'q25')},
      {s(f'quantile_cont({c}, 0.5)', 'q50')}, {s(f'quantile_cont({c}, 0.75)', 'q75')} FROM prices_quotes"""
    for c in ("min_price", "max_price", "modal_price")))
def _(spark, d):
    return single(profile.describe_prices(prices_quotes(spark, d), ["min_price", "max_price", "modal_price"]))


@query("missing_report", f"""
    WITH g AS ({GAPPY_SQL})
    SELECT 'price' AS "column", count(*) - count(price) AS n_missing,
           {s('(count(*) - count(price)) * 100.0 / count(*)', 'pct')} FROM g""")
def _(spark, d):
    return single(profile.missing_report(gappy_orders(spark, d)))


@query("extent_summary", """
    SELECT count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
           count(DISTINCT commodity) AS n_commodities, count(DISTINCT source) AS n_sources FROM prices_orders""")
def _(spark, d):
    return profile.extent_summary(prices_orders(spark, d))


@query("eda_summary", f"""
    SELECT count(*) AS total_records, count(DISTINCT commodity) AS unique_commodities,
      count(DISTINCT state) AS unique_states, count(DISTINCT market) AS unique_markets, min(date) AS first_date,
      max(date) AS last_date, {s('avg(modal_price)', 'avg_price')}, {s('stddev_samp(modal_price)', 'price_std')},
      {s('min(modal_price)', 'min_price')}, {s('max(modal_price)', 'max_price')} FROM prices_quotes""")
def _(spark, d):
    return single(profile.eda_summary(prices_quotes(spark, d)))


_PRICES = ("min_price", "max_price", "modal_price")


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 8, 'r')} FROM prices_quotes"
    for a in _PRICES for b in _PRICES))
def _(spark, d):
    return rounded(profile.corr_matrix(prices_quotes(spark, d), _PRICES), 8)


@query("seasonal_month", f"""
    SELECT CAST(month(date) AS INT) AS month, {s('avg(price)', 'avg_price')} FROM daily_filled GROUP BY 1""")
def _(spark, d):
    return single(profile.seasonal_mean(daily_filled(spark, d), "month"))


@query("seasonal_weekday", f"""
    SELECT CAST(isodow(date) - 1 AS INT) AS weekday, {s('avg(price)', 'avg_price')} FROM daily_filled GROUP BY 1""")
def _(spark, d):
    return single(profile.seasonal_mean(daily_filled(spark, d), "weekday"))


@query("histogram_prices", f"""
    WITH kept AS (SELECT price FROM prices_events WHERE price > 0
                  AND price < (SELECT quantile_cont(price, 0.99) FROM prices_events)),
    st AS (SELECT min(price) AS lo, max(price) AS hi, avg(price) AS m, quantile_cont(price, 0.5) AS md FROM kept)
    SELECT bin, {s('lo + bin * ((hi - lo) / 50)', '"left"')}, {s('lo + (bin + 1) * ((hi - lo) / 50)', '"right"')},
           count(*) AS n, {s('m', 'mean')}, {s('md', 'median')}
    FROM (SELECT CAST(least(floor((price - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, st.* FROM kept, st)
    GROUP BY bin, lo, hi, m, md""")
def _(spark, d):
    return single(profile.histogram_prices(prices_events(spark, d)))


@query("boxplot_stats", f"""
    WITH q AS (SELECT commodity, quantile_cont(modal_price, 0.25) AS q25, quantile_cont(modal_price, 0.5) AS q50,
                      quantile_cont(modal_price, 0.75) AS q75 FROM prices_quotes GROUP BY commodity)
    SELECT commodity, {s('q25')}, {s('q50')}, {s('q75')},
      {s('min(CASE WHEN inside THEN modal_price END)', 'whisker_low')},
      {s('max(CASE WHEN inside THEN modal_price END)', 'whisker_high')},
      CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers, count(*) AS n
    FROM (SELECT *, modal_price BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside
          FROM prices_quotes JOIN q USING (commodity)) GROUP BY commodity, q25, q50, q75""")
def _(spark, d):
    return single(profile.boxplot_stats(prices_quotes(spark, d), "commodity", "modal_price"))


@query("trend_line", f"""
    SELECT model, {r('regr_slope(y_pred, y_true)', 8, 'slope')}, {r('regr_intercept(y_pred, y_true)', 3, 'intercept')}
    FROM forecasts GROUP BY model""")
def _(spark, d):
    lines = profile.trend_line(forecasts(spark, d), ["model"], "y_true", "y_pred")
    return rounded(rounded(lines, 8, ["slope"]), 3, ["intercept"])


@query("sort_series", """
    SELECT commodity, date, row_id, price, row_number() OVER (PARTITION BY commodity ORDER BY date, row_id) - 1 AS idx
    FROM prices_orders ORDER BY commodity, date, row_id""")
def _(spark, d):
    rows = series_index(prices_orders(spark, d), ["commodity"], "date", "row_id")
    return rows.select("commodity", "date", "row_id", "price", "idx").orderBy("commodity", "date", "row_id")


@query("systematic_sample", """
    WITH i AS (SELECT *, row_number() OVER (ORDER BY date, row_id) - 1 AS idx FROM prices_orders)
    SELECT idx, row_id, price FROM i WHERE idx % 3 = 0""")
def _(spark, d):
    rows = series_index(prices_orders(spark, d), [], "date", "row_id")
    return profile.systematic_sample(rows, "idx", 3).select("idx", "row_id", "price")
