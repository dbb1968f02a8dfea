"""Window features of the gap-free daily series, and the row-grain panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import panel
from ..sources.views import daily_filled, prices_orders
from .clean_queries import logged
from .registry import query, r, rounded, s, single, t, tidy

KEY = ["commodity"]
W = "PARTITION BY commodity ORDER BY date"


def over(k: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER ({W})"


def base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ft.Frames]:
    return daily_filled(spark, sf_dir), ft.Frames(KEY)


def out(df: DataFrame, columns: dict) -> DataFrame:
    return df.select("commodity", "date", *[c.alias(k) for k, c in columns.items()])


def sql(columns: dict[str, str], fmt) -> str:
    return "SELECT commodity, date, " + ", ".join(fmt(e, k) for k, e in columns.items()) + " FROM daily_filled"


def r4(e: str, k: str) -> str:
    return r(e, 4, k)


def r6(e: str, k: str) -> str:
    return r(e, 6, k)


@query("lag_features", sql({f"price_lag_{k}": lag("price", k) for k in ft.LAGS}, s))
def _(spark, d):
    df, f = base(spark, d)
    return single(out(df.withColumns(ft.past_columns(f, "price")), ft.lag_columns()))


@query("diff_features", sql({f"price_diff_{k}": f"price - {lag('price', k)}" for k in ft.LAGS}, t))
def _(spark, d):
    df, f = base(spark, d)
    return tidy(out(df.withColumns(ft.past_columns(f, "price")), ft.diff_columns("price")))


@query("pct_change_features", sql(
    {f"price_pct_change_{k}": f"100 * (price / {lag('price', k)} - 1)" for k in ft.LAGS}, r6))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.past_columns(f, "price")), ft.pct_change_columns("price")), 6)


@query("momentum_features", sql(
    {f"momentum_{n}": f"price - {lag('price', k)}" for n, k in ft.MOMENTUM.items()}, t))
def _(spark, d):
    df, f = base(spark, d)
    return tidy(out(df.withColumns(ft.past_columns(f, "price", [3, 7, 14])), ft.momentum_columns("price")))


@query("sma", sql({f"sma_{k}": f"avg(price) {over(k)}" for k in ft.WINDOWS}, s))
def _(spark, d):
    df, f = base(spark, d)
    return single(out(df, ft.sma_columns(f, "price")))


@query("rolling_std", sql({f"rolling_std_{k}": f"stddev_samp(price) {over(k)}" for k in ft.WINDOWS}, t))
def _(spark, d):
    df, f = base(spark, d)
    return tidy(out(df, ft.std_columns(f, "price")))


@query("rolling_min_max", sql(
    {f"rolling_{m}_{k}": f"{m}(price) {over(k)}" for k in ft.WINDOWS for m in ("min", "max")}, s))
def _(spark, d):
    df, f = base(spark, d)
    return single(out(df, ft.min_max_columns(f, "price")))


@query("rolling_median", sql({f"rolling_median_{k}": f"quantile_cont(price, 0.5) {over(k)}" for k in ft.WINDOWS}, s))
def _(spark, d):
    df, f = base(spark, d)
    return single(out(df, ft.median_columns(f, "price")))


@query("price_range", sql(
    {f"price_range_{k}": f"max(price) {over(k)} - min(price) {over(k)}" for k in ft.WINDOWS}, t))
def _(spark, d):
    df, f = base(spark, d)
    return tidy(out(df.withColumns(ft.min_max_columns(f, "price")), ft.range_columns()))


@query("price_to_sma", sql({f"price_to_sma_{k}": f"price / (avg(price) {over(k)} + 1e-8)" for k in ft.WINDOWS}, r6))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.sma_columns(f, "price")), ft.price_to_sma_columns("price")), 6)


def _moment(fn: str, k: int, need: int, flat: float) -> str:
    return (f"CASE WHEN count(price) {over(k)} >= {need} THEN CASE WHEN min(price) {over(k)} = max(price) {over(k)} "
            f"THEN {flat} ELSE {fn}(price) {over(k)} END END")


@query("rolling_skew", sql({f"rolling_skew_{k}": _moment("skewness", k, 3, 0.0) for k in ft.WINDOWS}, r4))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.min_max_columns(f, "price") | ft.shape_columns(f, "price")), ft.skew_columns()), 4)


@query("rolling_kurt", sql({f"rolling_kurt_{k}": _moment("kurtosis", k, 4, -3.0) for k in ft.WINDOWS}, r4))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.min_max_columns(f, "price") | ft.shape_columns(f, "price")), ft.kurt_columns()), 4)


# --- exponential means: the recursion itself in SQL ------------------------------------

EMA_BASE = f"SELECT *, row_number() OVER ({W}) AS rn FROM daily_filled"


def ema_sql(spans: dict[str, int]) -> str:
    """Body of a recursive CTE `e` with one column per span, next to `b` (rows with rn)."""
    first = ", ".join(f"price AS {n}" for n in spans)
    step = ", ".join(
        f"b.price * CAST({2 / (k + 1)!r} AS DOUBLE) + (1 - CAST({2 / (k + 1)!r} AS DOUBLE)) * e.{n}" for n, k in spans.items())
    return (f"b AS MATERIALIZED ({EMA_BASE}), e AS (SELECT commodity, date, price, rn, {first} FROM b WHERE rn = 1 UNION ALL "
            f"SELECT b.commodity, b.date, b.price, b.rn, {step} FROM e JOIN b ON b.commodity = e.commodity AND b.rn = e.rn + 1)")


EMA3 = {"ema_7": 7, "ema_14": 14, "ema_21": 21}


@query("ema", f"WITH RECURSIVE {ema_sql(EMA3)} SELECT commodity, date, {', '.join(s(n) for n in EMA3)} FROM e")
def _(spark, d):
    return single(ft.ema(daily_filled(spark, d), KEY).drop("price"))


@query("ema_cross", f"""WITH RECURSIVE {ema_sql(EMA3)}
    SELECT commodity, date, {r('ema_7 / (ema_21 + 1e-8)', 6, 'ema_7_21_ratio')},
           CAST(ema_7 > ema_21 AS INT) AS ema_crossover FROM e""")
def _(spark, d):
    return rounded(out(ft.ema(daily_filled(spark, d), KEY), ft.ema_cross_columns()), 6)


@query("price_pressure", f"""WITH RECURSIVE {ema_sql(EMA3)}
    SELECT commodity, date, {r('(ema_7 - ema_21) / (ema_21 + 1e-8)', 6, 'price_pressure')} FROM e""")
def _(spark, d):
    return rounded(out(ft.ema(daily_filled(spark, d), KEY), {"price_pressure": ft.price_pressure_column()}), 6)


MACD_SQL = f"""WITH RECURSIVE {ema_sql({'e12': 12, 'e26': 26})},
    m AS MATERIALIZED (SELECT commodity, date, rn, e12 - e26 AS macd FROM e),
    g AS (SELECT commodity, date, rn, macd, macd AS macd_signal FROM m WHERE rn = 1 UNION ALL
          SELECT m.commodity, m.date, m.rn, m.macd, m.macd * CAST(0.2 AS DOUBLE) + (1 - CAST(0.2 AS DOUBLE)) * g.macd_signal
          FROM g JOIN m ON m.commodity = g.commodity AND m.rn = g.rn + 1)"""


@query("macd", f"""{MACD_SQL} SELECT commodity, date, {r('macd', 4)}, {r('macd_signal', 4)},
    {r('macd - macd_signal', 4, 'macd_histogram')}, CAST(macd > macd_signal AS INT) AS macd_crossover FROM g""")
def _(spark, d):
    return rounded(ft.macd(daily_filled(spark, d), KEY).drop("price"), 4)


# --- indicators ------------------------------------------------------------------------

MOVES = f"""(SELECT *, greatest(coalesce(price - {lag('price', 1)}, 0), 0) AS gain,
    greatest(coalesce({lag('price', 1)} - price, 0), 0) AS loss FROM daily_filled)"""


@query("rsi", "SELECT commodity, date, " + ", ".join(
    r(f"100 - 100 / (1 + avg(gain) {over(k)} / (avg(loss) {over(k)} + 1e-8))", 6, f"rsi_{k}") for k in ft.RSI_PERIODS)
    + f" FROM {MOVES}")
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.past_columns(f, "price", [1])).withColumns(ft.move_columns("price")), ft.rsi_columns(f)), 6)


@query("bollinger", f"""
    SELECT commodity, date, {t('m', 'bb_middle')}, {t('m + 2 * sd', 'bb_upper')}, {t('m - 2 * sd', 'bb_lower')},
      {t('4 * sd / (m + 1e-8)', 'bb_width')}, {t('(price - (m - 2 * sd)) / (4 * sd + 1e-8)', 'bb_pct_b')}
    FROM (SELECT *, avg(price) {over(20)} AS m, stddev_samp(price) {over(20)} AS sd FROM daily_filled)""")
def _(spark, d):
    df, f = base(spark, d)
    return tidy(out(df.withColumns(ft.band_columns(f, "price")), ft.bollinger_columns("price")))


@query("roc", sql({f"roc_{k}": f"100 * (price - {lag('price', k)}) / ({lag('price', k)} + 1e-8)" for k in ft.ROC_PERIODS}, r6))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.past_columns(f, "price", ft.ROC_PERIODS)), ft.roc_columns("price")), 6)


@query("cci", f"""
    SELECT commodity, date, {r("(price - m) / (0.015 * list_avg(list_transform(xs, lambda x: abs(x - m))) + 1e-8)", 5, 'cci')}
    FROM (SELECT *, avg(price) {over(20)} AS m, list(price) {over(20)} AS xs FROM daily_filled)""")
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.band_columns(f, "price")), {"cci": ft.cci_column("price")}), 5)


STOCH = f"100 * (price - min(price) {over(14)}) / (max(price) {over(14)} - min(price) {over(14)} + 1e-8)"


@query("stochastic", f"""
    SELECT commodity, date, {r('k', 6, 'stoch_k')}, {r(f'avg(k) {over(3)}', 6, 'stoch_d')}
    FROM (SELECT *, {STOCH} AS k FROM daily_filled)""")
def _(spark, d):
    df, f = base(spark, d)
    df = df.withColumns(ft.extreme_columns(f, "price")).withColumn("stoch_k", ft.stoch_k_column("price"))
    return rounded(out(df, {"stoch_k": F.col("stoch_k"), "stoch_d": ft.stoch_d_column(f)}), 6)


@query("inflation_proxy", f"""
    SELECT commodity, date, {r(f'100 * avg(c30) {over(30)}', 6, 'inflation_proxy_30d')},
      {r(f'100 * avg(c90) {over(30)}', 6, 'inflation_proxy_90d')}
    FROM (SELECT *, price / {lag('price', 30)} - 1 AS c30, price / {lag('price', 90)} - 1 AS c90 FROM daily_filled)""")
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.past_columns(f, "price", [30, 90])).withColumns(ft.change_columns("price")), ft.inflation_columns(f)), 6)


@query("demand_index", sql(
    {"demand_index": f"(price - avg(price) {over(30)}) / (avg(price) {over(30)} + 1e-8)"}, r6))
def _(spark, d):
    df, f = base(spark, d)
    return rounded(out(df.withColumns(ft.spread_columns(f, "price")), {"demand_index": ft.demand_column("price")}), 6)


@query("supply_disruption", f"""
    SELECT commodity, date, {r('s7 / avg(s30) OVER (PARTITION BY commodity)', 6, 'supply_disruption_proxy')}
    FROM (SELECT *, stddev_samp(price) {over(7)} AS s7, stddev_samp(price) {over(30)} AS s30 FROM daily_filled)""")
def _(spark, d):
    df, f = base(spark, d)
    df = df.withColumns(ft.spread_columns(f, "price")).withColumn("_typical", ft.typical_spread_column(KEY))
    return rounded(out(df, {"supply_disruption_proxy": ft.supply_disruption_column()}), 6)


_FLAT = f"(min(a) {over(14)} = max(a) {over(14)} OR min(b) {over(14)} = max(b) {over(14)})"
AUTOCORR = (f"CASE WHEN count(b) {over(14)} > 1 AND NOT {_FLAT} THEN covar_pop(a, b) {over(14)} / "
            f"(stddev_pop(a) {over(14)} * stddev_pop(b) {over(14)}) END")
PAST = f"""(SELECT commodity, date, price, {lag('price', 7)} AS b,
    CASE WHEN {lag('price', 7)} IS NOT NULL THEN price END AS a FROM daily_filled)"""


@query("rolling_autocorr", f"SELECT commodity, date, {r(AUTOCORR, 5, 'global_market_proxy')} FROM {PAST}")
def _(spark, d):
    df, f = base(spark, d)
    df = df.withColumn("_past", f.lag("price", 7))
    return rounded(out(df, {"global_market_proxy": ft.autocorr_column(f, "price", "_past")}), 5)


@query("strict_ma", sql(
    {f"ma_{k}": f"CASE WHEN count(price) {over(k)} = {k} THEN avg(price) {over(k)} END" for k in (7, 30)}, s))
def _(spark, d):
    df, f = base(spark, d)
    return single(out(df, ft.strict_ma_columns(f, "price")))


# --- the whole set ---------------------------------------------------------------------

def _all_sql() -> str:
    """Every feature in SQL, then fill and zero in the order the library applies them."""
    level, first = [], []
    for k in ft.LAGS:
        first += [f"{lag('price', k)} AS price_lag_{k}", f"price - {lag('price', k)} AS price_diff_{k}",
                  f"100 * (price / {lag('price', k)} - 1) AS price_pct_change_{k}"]
    first += [f"price - {lag('price', k)} AS momentum_{n}" for n, k in ft.MOMENTUM.items()]
    for k in ft.WINDOWS:
        first += [
            f"avg(price) {over(k)} AS sma_{k}", f"stddev_samp(price) {over(k)} AS rolling_std_{k}",
            f"min(price) {over(k)} AS rolling_min_{k}", f"max(price) {over(k)} AS rolling_max_{k}",
            f"quantile_cont(price, 0.5) {over(k)} AS rolling_median_{k}",
            f"max(price) {over(k)} - min(price) {over(k)} AS price_range_{k}",
            f"price / (avg(price) {over(k)} + 1e-8) AS price_to_sma_{k}",
            f"{_moment('skewness', k, 3, 0.0)} AS rolling_skew_{k}",
            f"{_moment('kurtosis', k, 4, -3.0)} AS rolling_kurt_{k}",
        ]
    m, sd = f"avg(price) {over(20)}", f"stddev_samp(price) {over(20)}"
    first += [
        f"{m} AS bb_middle", f"{m} + 2 * {sd} AS bb_upper", f"{m} - 2 * {sd} AS bb_lower",
        f"4 * {sd} / ({m} + 1e-8) AS bb_width", f"(price - ({m} - 2 * {sd})) / (4 * {sd} + 1e-8) AS bb_pct_b",
        *[f"100 * (price - {lag('price', k)}) / ({lag('price', k)} + 1e-8) AS roc_{k}" for k in ft.ROC_PERIODS],
        f"{STOCH} AS stoch_k", f"(price - avg(price) {over(30)}) / (avg(price) {over(30)} + 1e-8) AS demand_index",
        f"list(price) {over(20)} AS xs", f"{lag('price', 7)} AS b",
        f"CASE WHEN {lag('price', 7)} IS NOT NULL THEN price END AS a",
        f"greatest(coalesce(price - {lag('price', 1)}, 0), 0) AS gain",
        f"greatest(coalesce({lag('price', 1)} - price, 0), 0) AS loss",
        f"price / {lag('price', 30)} - 1 AS c30", f"price / {lag('price', 90)} - 1 AS c90",
    ]
    drop = "xs, a, b, gain, loss, c30, c90, e7, e14, e21, e12, e26, rn, macd_line, macd_sig"
    level = [
        "(price - bb_middle) / (0.015 * list_avg(list_transform(xs, lambda x: abs(x - bb_middle))) + 1e-8) AS cci",
        *[f"100 - 100 / (1 + avg(gain) {over(k)} / (avg(loss) {over(k)} + 1e-8)) AS rsi_{k}" for k in ft.RSI_PERIODS],
        f"avg(stoch_k) {over(3)} AS stoch_d", "e7 AS ema_7", "e14 AS ema_14", "e21 AS ema_21",
        "e7 / (e21 + 1e-8) AS ema_7_21_ratio", "CAST(e7 > e21 AS INT) AS ema_crossover",
        "(e7 - e21) / (e21 + 1e-8) AS price_pressure", "macd_line AS macd", "macd_sig AS macd_signal",
        "macd_line - macd_sig AS macd_histogram", "CAST(macd_line > macd_sig AS INT) AS macd_crossover",
        f"100 * avg(c30) {over(30)} AS inflation_proxy_30d", f"100 * avg(c90) {over(30)} AS inflation_proxy_90d",
        "rolling_std_7 / avg(rolling_std_30) OVER (PARTITION BY commodity) AS supply_disruption_proxy",
        f"{AUTOCORR} AS global_market_proxy",
        "CAST(list_extract([0.3, 0.35, 0.5, 0.7, 0.85, 0.95, 1.0, 0.95, 0.8, 0.5, 0.35, 0.3], month(date)) AS DOUBLE) AS weather_index",
        "CAST(list_extract([0.3, 0.4, 0.6, 0.8, 0.95, 0.9, 0.75, 0.7, 0.65, 0.5, 0.35, 0.3], month(date)) AS DOUBLE) AS temp_index",
        "CAST(isodow(date) - 1 AS INT) AS day_of_week", "CAST(day(date) AS INT) AS day_of_month",
        "CAST(dayofyear(date) AS INT) AS day_of_year", "CAST(weekofyear(date) AS INT) AS week_of_year",
        "CAST(month(date) AS INT) AS month", "CAST(quarter(date) AS INT) AS quarter", "CAST(year(date) AS INT) AS year",
        "CAST(isodow(date) >= 6 AS INT) AS is_weekend", "CAST(day(date) = 1 AS INT) AS is_month_start",
        "CAST(date = last_day(date) AS INT) AS is_month_end",
        "CAST(day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS INT) AS is_quarter_start",
        "CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS INT) AS is_quarter_end",
        "CAST(month(date) BETWEEN 6 AND 10 AS INT) AS season_kharif",
        "CAST(month(date) IN (11, 12, 1, 2, 3) AS INT) AS season_rabi",
        "CAST(month(date) IN (4, 5) AS INT) AS season_zaid",
        "CAST(month(date) IN (10, 11) AS INT) AS is_festival_season",
        *[f"{fn}(2 * pi() * {v} / {p}) AS {n}_{fn}" for n, v, p in (
            ("month", "month(date)", 12), ("day_of_week", "(isodow(date) - 1)", 7), ("day_of_year", "dayofyear(date)", 365))
          for fn in ("sin", "cos")],
    ]
    spans = {"e7": 7, "e14": 14, "e21": 21, "e12": 12, "e26": 26}
    names = [x.rsplit(" AS ", 1)[1] for x in first + level]
    skip = set(drop.split(", "))
    names = [n for n in names if n not in skip]
    ints = {n for x in level if x.startswith("CAST(") and " AS INT)" in x for n in [x.rsplit(" AS ", 1)[1]]}
    done = []
    for n in ["price", *names]:
        if n in ints:
            done.append(n)
            continue
        fill = (f"coalesce(last_value({n} IGNORE NULLS) OVER ({W}), first_value({n} IGNORE NULLS) OVER "
                f"({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)")
        done.append(t(fill, n, 5))
    return f"""WITH RECURSIVE {ema_sql(spans)},
        m AS MATERIALIZED (SELECT commodity, date, rn, e12 - e26 AS macd_line FROM e),
        g AS (SELECT commodity, date, rn, macd_line, macd_line AS macd_sig FROM m WHERE rn = 1 UNION ALL
              SELECT m.commodity, m.date, m.rn, m.macd_line,
                     m.macd_line * CAST(0.2 AS DOUBLE) + (1 - CAST(0.2 AS DOUBLE)) * g.macd_sig
              FROM g JOIN m ON m.commodity = g.commodity AND m.rn = g.rn + 1),
        one AS (SELECT e.*, g.macd_line, g.macd_sig FROM e JOIN g USING (commodity, rn)),
        two AS (SELECT *, {", ".join(first)} FROM one),
        three AS (SELECT *, {", ".join(level)} FROM two)
        SELECT commodity, date, {", ".join(done)} FROM three"""


@query("all_features", _all_sql())
def _(spark, d):
    return tidy(ft.all_features(daily_filled(spark, d), KEY), 5)


# --- row-grain panel -------------------------------------------------------------------

PW = "PARTITION BY commodity_clean ORDER BY date, row_id"
Z_SQL = """z AS (SELECT o.*, least(greatest((price_log - m) / sd, -5), 5) AS z FROM
    (SELECT row_id, date, price, lower(commodity) AS commodity_clean, ln(1 + price) AS price_log FROM {src}) o
    JOIN (SELECT lower(commodity) AS commodity_clean, avg(ln(1 + price)) AS m,
                 CASE WHEN stddev_samp(ln(1 + price)) = 0 THEN 1 ELSE stddev_samp(ln(1 + price)) END AS sd
          FROM {src} GROUP BY 1) USING (commodity_clean))"""
ZALL = Z_SQL.format(src="prices_orders")


def zscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.zscore(panel.join_group_stats(logged(spark, sf_dir), "commodity_clean"))


@query("zscore_panel", f"WITH {ZALL} SELECT row_id, commodity_clean, {r('z', 8, 'price_normalized')} FROM z")
def _(spark, d):
    return rounded(zscored(spark, d).select("row_id", "commodity_clean", "price_normalized"), 8)


LOG_RETURN = f"least(greatest(coalesce(price_log - lag(price_log) OVER ({PW}), 0), -0.5), 0.5)"


@query("log_return", f"WITH {ZALL} SELECT row_id, commodity_clean, {r(LOG_RETURN, 8, 'log_return')} FROM z")
def _(spark, d):
    rows = panel.log_return(logged(spark, d), "commodity_clean", "row_id")
    return rounded(rows.select("row_id", "commodity_clean", "log_return"), 8)


def prow(k: int) -> str:
    return f"OVER ({PW} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


ROLL = {f"ma_{k}": f"avg(z) {prow(k)}" for k in (7, 14, 30)} | {
    f"std_{k}": f"coalesce(stddev_samp(z) {prow(k)}, 0)" for k in (7, 14, 30)}


@query("panel_rolling", f"WITH {ZALL} SELECT row_id, {', '.join(r(e, 7, k) for k, e in ROLL.items())} FROM z")
def _(spark, d):
    rows = panel.panel_rolling(zscored(spark, d), "commodity_clean", "row_id")
    return rounded(rows.select("row_id", *ROLL), 7)


@query("panel_momentum", f"WITH {ZALL} SELECT row_id, {r(f'z - avg(z) {prow(7)}', 7, 'momentum')} FROM z")
def _(spark, d):
    rows = panel.panel_features(zscored(spark, d), "commodity_clean", "row_id")
    return rounded(rows.select("row_id", "momentum"), 7)


_NAMES = ["1-urgent", "2-high", "3-medium", "4-not specified", "5-low"]
_CYC = [(f"{n}_{fn}", f"{fn}(2 * pi() * {v} / {p})") for n, v, p in (
    ("day_of_week", "(isodow(date) - 1)", 7), ("month", "month(date)", 12), ("day_of_year", "dayofyear(date)", 365))
    for fn in ("sin", "cos")]


@query("processed_panel", f"""
    WITH fenced AS (SELECT t.* FROM prices_orders t,
        (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM prices_orders) q
        WHERE price >= greatest(0, a - 1.5 * (b - a)) AND price <= b + 1.5 * (b - a)),
    {Z_SQL.format(src='fenced').replace('o.*,', 'o.*, m, sd,')}
    SELECT row_id, date, price, commodity_clean, {r('price_log', 5)}, {r('z', 5, 'price_normalized')},
      {r(LOG_RETURN, 5, 'log_return')}, {r('m', 5, 'commodity_mean')}, {r('sd', 5, 'commodity_std')},
      {', '.join(r(e, 5, k) for k, e in ROLL.items())}, {r(f'z - avg(z) {prow(7)}', 5, 'momentum')},
      {', '.join(r(e, 5, k) for k, e in _CYC)},
      {', '.join(f"CAST(commodity_clean = '{n}' AS DOUBLE) AS is_{n.replace(' ', '_').replace('-', '_')}" for n in _NAMES)}
    FROM z""")
def _(spark, d):
    rows = panel.processed_panel(prices_orders(spark, d), "row_id")
    return rounded(rows, 5, [c for c, t in rows.dtypes if t == "double" and c != "price"])
