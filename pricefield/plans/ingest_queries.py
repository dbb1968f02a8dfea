"""Sources, adapters, union, dedup and result tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arithmetic import number
from ..functions.text import strict_date
from ..operators import daily, profile
from ..operators.metrics import mae, mape, r2, rmse
from ..session import shared_folder
from ..sources import adapters, files
from ..sources.schemas import column_or, normalize_header
from ..sources.views import daily_commodity, forecasts, prices_events, prices_orders, prices_quotes
from .flows import combine_sources, preprocess_quotes
from .registry import query, r, rounded, s, single


# Raw text layouts made from the test tables. Some cells are spoiled on purpose.

def raw_mandi(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("row_id") % 97 == 0, "bad").otherwise(F.date_format("date", "dd-MM-yyyy"))
    price = F.when(F.col("row_id") % 89 == 0, "n/a").otherwise(F.col("price").cast("string"))
    return prices_orders(spark, sf_dir).select(
        F.col("source").alias("State"), F.concat(F.lit("Market "), "source").alias("Market"),
        F.concat(F.lit(" "), "commodity", F.lit("  ")).alias("Commodity"), day.alias("Arrival Date"),
        price.alias("Modal Price"), "row_id",
    )


def raw_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices_orders(spark, sf_dir).select(
        F.when(F.col("row_id") % 97 == 0, "soon").otherwise(F.col("date").cast("string")).alias("date"),
        F.col("price").cast("string").alias("price"), "commodity",
    )


def results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result row per forecaster and commodity."""
    rows = forecasts(spark, sf_dir).withColumn("model", F.concat_ws("@", "model", "commodity"))
    table = rows.groupBy("model").agg(
        rmse().alias("rmse"), mae().alias("mae"), mape().alias("mape"), r2().alias("r2"),
        (F.count(F.lit(1)) * 1000).alias("params"),
    )
    return table


RESULTS_SQL = """
    SELECT model || '@' || commodity AS model, sqrt(avg((y_true - y_pred) ** 2)) AS rmse,
           avg(abs(y_true - y_pred)) AS mae,
           avg(abs((y_true - y_pred) / nullif(y_true, 0))) * 100 AS mape,
           1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*)) AS r2, count(*) * 1000 AS params
    FROM forecasts GROUP BY 1"""


@query("scan_prices", "SELECT date, price, commodity, source, row_id FROM prices_orders")
def _(spark, d):
    return prices_orders(spark, d)


@query("normalize_header", f"""
    SELECT state, market, commodity, strftime(date, '%d-%m-%Y') AS arrival_date, {r('min_price', 4)},
           {r('max_price', 4)}, modal_price FROM prices_quotes""")
def _(spark, d):
    raw = prices_quotes(spark, d).select(
        F.col("state").alias(" State "), F.col("market").alias("Market"), F.col("commodity").alias("Commodity "),
        F.date_format("date", "dd-MM-yyyy").alias("Arrival Date"), F.col("min_price").alias("Min Price"),
        F.col("max_price").alias(" Max Price"), F.col("modal_price").alias("Modal Price"),
    )
    return rounded(normalize_header(raw), 4, ["min_price", "max_price"])


@query("resolve_columns", """
    SELECT date, modal_price AS price, commodity, 'unknown' AS grade FROM prices_quotes""")
def _(spark, d):
    raw = normalize_header(prices_quotes(spark, d).select(
        F.col("date").alias("Trade Date"), F.col("modal_price").alias("Average Price"),
        F.col("commodity").alias("Item Name"), "arrivals",
    ))
    return raw.select(
        column_or(raw, "", "date").alias("date"), column_or(raw, "", "average", "price").alias("price"),
        column_or(raw, "unknown", "commodity", "item").alias("commodity"),
        column_or(raw, "unknown", "grade", "quality").alias("grade"),
    )


@query("src_mandi", """
    SELECT date, price, lower(commodity) AS commodity, 'agriculture_india' AS source
    FROM prices_orders WHERE row_id % 97 <> 0 AND row_id % 89 <> 0""")
def _(spark, d):
    return adapters.mandi(raw_mandi(spark, d), trim=True)


@query("src_wfp_india", """
    SELECT date, price, lower(commodity) AS commodity, 'india_wfp' AS source
    FROM prices_orders WHERE row_id % 97 <> 0""")
def _(spark, d):
    rows = raw_iso(spark, d)
    tag = rows.limit(1).select(
        F.lit("#date").alias("date"), F.lit("#value").alias("price"), F.lit("#item+name").alias("commodity")
    )
    return adapters.wfp_india(rows.unionByName(tag))


@query("src_kalimati", """
    SELECT date, modal_price AS price, lower(commodity) AS commodity, 'kalimati_nepal' AS source
    FROM prices_quotes""")
def _(spark, d):
    raw = prices_quotes(spark, d).select(
        F.col("commodity").alias("Commodity"), F.col("date").cast("string").alias("Date"),
        F.lit("Kg").alias("Unit"), F.col("min_price").alias("Minimum"), F.col("max_price").alias("Maximum"),
        F.col("modal_price").alias("Average"),
    )
    return adapters.kalimati(raw)


@query("src_wfp_global", """
    SELECT make_date(year(date), month(date), 15) AS date, price, lower(commodity) AS commodity,
           'wfp_global' AS source FROM prices_orders WHERE row_id % 97 <> 0""")
def _(spark, d):
    month = F.when(F.col("row_id") % 97 == 0, 13).otherwise(F.month("date"))
    raw = prices_orders(spark, d).select(
        F.year("date").cast("string").alias("mp_year"), month.cast("string").alias("mp_month"),
        F.col("price").alias("mp_price"), F.col("commodity").alias("cm_name"),
    )
    return adapters.wfp_global(raw)


def wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per commodity. Five fixed priorities make the column list."""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    daily = daily_commodity(spark, sf_dir)
    wide = daily.groupBy(F.col("date").alias("Date")).pivot("commodity", names).agg(F.first("price"))
    return wide


@query("unpivot_wide", f"""
    SELECT date, {r('price', 6)}, lower(commodity) AS commodity, 'commodity_futures' AS source
    FROM daily_commodity""")
def _(spark, d):
    return rounded(adapters.wide_futures(wide_prices(spark, d)), 6)


@query("src_futures_long", """
    SELECT date, price, lower(commodity) AS commodity, 'commodity_futures' AS source FROM prices_orders""")
def _(spark, d):
    raw = prices_orders(spark, d).select(
        F.date_format("date", "M/d/yyyy").alias("Trade Date"), F.col("price").alias("Close"),
        F.col("commodity").alias("Symbol"),
    )
    return adapters.long_futures(raw)


@query("src_crop_yearly", """
    SELECT make_date(year(date), 1, 1) AS date, modal_price AS price, lower(commodity) AS commodity,
           'crop_prediction' AS source FROM prices_quotes""")
def _(spark, d):
    raw = prices_quotes(spark, d).select(
        F.year("date").alias("Year"), F.col("commodity").alias("Crop"), F.col("modal_price").alias("Production")
    )
    return adapters.crop_yearly(raw)


@query("union_sources", """
    SELECT date, price, lower(commodity) AS commodity, 'agriculture_india' AS source, 0 AS priority
    FROM prices_orders WHERE row_id % 97 <> 0 AND row_id % 89 <> 0
    UNION ALL SELECT date, price, commodity, source, 1 FROM prices_events
    UNION ALL SELECT date, price, lower(commodity), 'india_wfp', 2 FROM prices_orders WHERE row_id % 97 <> 0""")
def union_of_sources(spark, d):
    return adapters.union_sources([
        adapters.mandi(raw_mandi(spark, d), trim=True), prices_events(spark, d),
        adapters.wfp_india(raw_iso(spark, d)),
    ])


@query("dedup_quotes", """
    SELECT date, price, commodity, arg_min(source, priority) AS source FROM (
      SELECT date, price, lower(commodity) AS commodity, 'agriculture_india' AS source, 0 AS priority
      FROM prices_orders WHERE row_id % 97 <> 0 AND row_id % 89 <> 0
      UNION ALL SELECT date, price, commodity, source, 1 FROM prices_events
      UNION ALL SELECT date, price, lower(commodity), 'india_wfp', 2 FROM prices_orders WHERE row_id % 97 <> 0)
    GROUP BY date, price, commodity""")
def _(spark, d):
    return adapters.dedup_quotes(union_of_sources(spark, d))


@query("results_append_rank", f"""
    WITH res AS ({RESULTS_SQL}),
    added AS (SELECT 'Hybrid' AS model, avg(rmse) AS rmse, avg(mae) AS mae, avg(mape) AS mape, avg(r2) AS r2,
                     CAST(sum(params) AS BIGINT) AS params FROM res)
    SELECT model, {r('rmse', 4)}, {r('mae', 4)}, {r('mape', 4)}, {r('r2', 6)}, params
    FROM (SELECT * FROM res UNION ALL SELECT * FROM added)""")
def _(spark, d):
    res = results_table(spark, d)
    hybrid = res.agg(
        F.lit("Hybrid").alias("model"), *[F.avg(c).alias(c) for c in ("rmse", "mae", "mape", "r2")],
        F.sum("params").alias("params"),
    )
    return rounded(rounded(profile.rank_results(res, hybrid), 4, ["rmse", "mae", "mape"]), 6, ["r2"])


@query("results_published", f"""
    WITH res AS ({RESULTS_SQL}),
    added AS (SELECT 'Hybrid' AS model, avg(rmse) AS rmse, avg(r2) AS r2, CAST(sum(params) AS BIGINT) AS params FROM res)
    SELECT v AS version, model, {r('rmse', 4)}, {r('r2', 6)}, params
    FROM (SELECT 1 AS v, model, rmse, r2, params FROM res UNION ALL SELECT 2, model, rmse, r2, params FROM res
          UNION ALL SELECT 2, * FROM added)""")
def _(spark, d):
    """Both versions of a results table to which a row was added."""
    folder = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    res = results_table(spark, d).select("model", "rmse", "r2", "params")
    files.append_published(spark, folder, res)
    hybrid = files.read_published(spark, folder).agg(
        F.lit("Hybrid").alias("model"), F.avg("rmse").alias("rmse"), F.avg("r2").alias("r2"), F.sum("params").alias("params"))
    files.append_published(spark, folder, hybrid)
    first, second = (files.read_published(spark, folder, v).withColumn("version", F.lit(v)) for v in (1, 2))
    return rounded(rounded(first.unionByName(second), 4, ["rmse"]), 6, ["r2"])


@query("rank_models", f"""
    WITH res AS ({RESULTS_SQL})
    SELECT model, {r('rmse', 4)}, {r('mae', 4)}, {r('mape', 4)}, {r('r2', 6)}, params
    FROM res ORDER BY res.rmse, model LIMIT 10""")
def _(spark, d):
    top = profile.rank_models(results_table(spark, d), "rmse", n=10)
    return rounded(rounded(top, 4, ["rmse", "mae", "mape"]), 6, ["r2"])


@query("parse_date_strict", """
    SELECT row_id, CASE WHEN row_id % 97 <> 0 THEN date END AS date FROM prices_orders""")
def _(spark, d):
    return raw_mandi(spark, d).select("row_id", strict_date("`Arrival Date`").alias("date"))


@query("coerce_numeric", """
    SELECT row_id, CASE WHEN row_id % 89 <> 0 THEN price END AS price FROM prices_orders""")
def _(spark, d):
    return raw_mandi(spark, d).select("row_id", number("`Modal Price`").alias("price"))


@query("normalize_text", """
    SELECT row_id, lower(trim(' ' || commodity || '  ')) AS commodity FROM prices_orders""")
def _(spark, d):
    return raw_mandi(spark, d).select("row_id", F.lower(F.trim("Commodity")).alias("commodity"))


# --- flows -----------------------------------------------------------------------------

COMBINED_SQL = """
    WITH u AS (SELECT date, price, lower(commodity) AS commodity, 'agriculture_india' AS source, 0 AS priority
      FROM prices_orders WHERE row_id % 97 <> 0 AND row_id % 89 <> 0
      UNION ALL SELECT date, price, commodity, source, 1 FROM prices_events
      UNION ALL SELECT date, price, lower(commodity), 'india_wfp', 2 FROM prices_orders WHERE row_id % 97 <> 0),
    dd AS (SELECT date, price, commodity, arg_min(source, priority) AS source FROM u GROUP BY date, price, commodity),
    q AS (SELECT quantile_cont(price, 0.005) AS a, quantile_cont(price, 0.995) AS b FROM dd),
    kept AS (SELECT dd.* FROM dd, q WHERE price > 0 AND price >= a AND price <= b)"""


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_sources([
        adapters.mandi(raw_mandi(spark, sf_dir), trim=True), prices_events(spark, sf_dir),
        adapters.wfp_india(raw_iso(spark, sf_dir)),
    ])


@query("combined_all", f"{COMBINED_SQL} SELECT date, price, commodity, source FROM kept")
def _(spark, d):
    return combined(spark, d)


@query("combined_daily", f"{COMBINED_SQL} SELECT date, {s('avg(price)', 'price')}, count(*) AS n_records FROM kept GROUP BY date")
def _(spark, d):
    return single(daily.daily_mean_count(combined(spark, d), []))


@query("preprocess_quotes", """
    WITH raw AS (SELECT row_id, date, commodity, CASE WHEN row_id % 89 <> 0 THEN price END AS p FROM prices_orders
                 WHERE row_id % 97 <> 0),
    filled AS (SELECT row_id, date, commodity, coalesce(
        last_value(p IGNORE NULLS) OVER (ORDER BY date, row_id ROWS UNBOUNDED PRECEDING),
        first_value(p IGNORE NULLS) OVER (ORDER BY date, row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS modal_price FROM raw),
    q AS (SELECT quantile_cont(modal_price, 0.01) AS a, quantile_cont(modal_price, 0.99) AS b FROM filled)
    SELECT row_id, date, trim(commodity) AS commodity, modal_price FROM filled, q
    WHERE modal_price BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def _(spark, d):
    rows = preprocess_quotes(raw_mandi(spark, d), "row_id")
    return rows.select("row_id", "date", F.trim("commodity").alias("commodity"), "modal_price")
