"""Metrics, ensembles, forecasters and the tables behind the charts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ensemble, forecasters, metrics, profile, scaling, sequences
from ..operators.daily import future_frame
from ..operators.ordering import series_index
from ..session import shared_folder
from ..sources.files import materialize
from ..sources.views import daily_filled, forecasts, prices_orders
from .flows import hybrid_flow
from .ingest_queries import RESULTS_SQL, results_table
from .registry import query, r, rounded, s, single, t, tidy

MODELS = ["naive", "seasonal_naive", "sma_7"]
KEY = ["commodity"]
KEYS = ["commodity", "idx"]
ERR = "(y_true - y_pred)"
FW = "PARTITION BY model, commodity ORDER BY idx"
DIRECTION = f"""(SELECT model, avg(CASE WHEN sign(y_true - pt) = sign(y_pred - pp) THEN 100.0 ELSE 0.0 END) AS directional_acc
    FROM (SELECT *, lag(y_true) OVER ({FW}) AS pt, lag(y_pred) OVER ({FW}) AS pp FROM forecasts) WHERE pt IS NOT NULL GROUP BY model)"""
METRIC_SQL = f"""SELECT model, sqrt(avg({ERR} ** 2)) AS rmse, avg(abs{ERR}) AS mae,
    100 * avg(abs({ERR} / nullif(y_true, 0))) AS mape, 1 - sum({ERR} ** 2) / (var_pop(y_true) * count(*)) AS r2,
    count(*) AS n FROM forecasts GROUP BY model"""
FIVE = ["rmse", "mae", "mape", "r2", "directional_acc"]


def table_of_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.forecast_metrics(forecasts(spark, sf_dir), KEY)


@query("baseline_forecasts", f"SELECT model, commodity, date, idx, {s('y_true')}, {s('y_pred')} FROM forecasts")
def _(spark, d):
    return single(forecasts(spark, d))


@query("forecast_metrics", f"""
    SELECT model, n, {', '.join(r(c, 6) for c in FIVE if c not in ('rmse', 'mae'))}, {s('rmse')}, {s('mae')}
    FROM ({METRIC_SQL}) JOIN {DIRECTION} USING (model)""")
def _(spark, d):
    return rounded(single(table_of_metrics(spark, d), ["rmse", "mae"]), 6, ["mape", "r2", "directional_acc"])


@query("mape_guarded", f"SELECT model, {r(f'100 * avg(abs({ERR} / (y_true + 1e-8)))', 6, 'mape')} FROM forecasts GROUP BY model")
def _(spark, d):
    return rounded(metrics.metric_table(forecasts(spark, d), {"mape": metrics.mape_guarded()}), 6)


@query("mape_capped", f"""
    SELECT model, {r(f'least(100 * avg(abs{ERR} / (abs(y_true) + 1e-8)), 999.9)', 6, 'mape')} FROM forecasts GROUP BY model""")
def _(spark, d):
    return rounded(metrics.metric_table(forecasts(spark, d), {"mape": metrics.mape_capped()}), 6)


@query("directional_accuracy", f"SELECT model, {r('directional_acc', 6)} FROM {DIRECTION}")
def _(spark, d):
    return rounded(metrics.directional_accuracy(forecasts(spark, d), KEY), 6)


@query("sign_accuracy", f"""
    SELECT model, {r('avg(CASE WHEN sign(y_true - 150000) = sign(y_pred - 150000) THEN 100.0 ELSE 0.0 END)', 6, 'directional_acc')}
    FROM forecasts GROUP BY model""")
def _(spark, d):
    level = {c: F.col(c) - 150_000 for c in ("y_true", "y_pred")}
    rows = forecasts(spark, d).withColumns(level)
    return rounded(metrics.metric_table(rows, {"directional_acc": metrics.sign_accuracy_column()}), 6)


def _avg_rank(c: str, part: str) -> str:
    return f"rank() OVER (PARTITION BY {part} ORDER BY {c}) + (count(*) OVER (PARTITION BY {part}, {c}) - 1) / 2.0"


@query("information_coefficient", f"""
    SELECT model, {r('corr(a, b)', 8, 'ic')}, count(*) AS n FROM (
      SELECT model, {_avg_rank('y_true', 'model')} AS a, {_avg_rank('y_pred', 'model')} AS b FROM forecasts) GROUP BY model""")
def _(spark, d):
    return rounded(metrics.information_coefficient(forecasts(spark, d)).drop("ic_pvalue"), 8)


# The terms of the power series as ratios of gamma functions, all of one sign: 1 - p is their sum.
IC_PVALUE = """1 - 2 * sqrt(x) * exp(h * ln(1 - x) + lgamma(h + 0.5) - lgamma(h) - 0.5 * ln(pi())) * list_sum(list_transform(
    range(0, 4000), lambda k: exp(lgamma(h + 0.5 + k) - lgamma(h + 0.5) - lgamma(1.5 + k) + lgamma(1.5) + k * ln(x))))"""


@query("ic_significance", f"""
    WITH i AS (
      SELECT model, commodity, year, corr(a, b) AS ic, count(*) AS n FROM (
        SELECT model, commodity, year, {_avg_rank('y_true', 'model, commodity, year')} AS a, {_avg_rank('step', 'model, commodity, year')} AS b
        FROM (SELECT model, commodity, year(date) AS year, y_true, idx % 97 AS step FROM forecasts))
      GROUP BY model, commodity, year),
    p AS (SELECT *, greatest(ic * ic, 1e-300) AS x, (n - 2) / 2.0 AS h FROM i WHERE n >= 3)
    SELECT model, commodity, CAST(year AS INT) AS year, n, {r('ic', 8)}, {r(IC_PVALUE, 8, 'ic_pvalue')} FROM p""")
def _(spark, d):
    """Rank correlation of the price with a saw tooth, per model, commodity and year: weak ones, so p-values vary."""
    saw = forecasts(spark, d).withColumns({"year": F.year("date"), "y_pred": (F.col("idx") % 97).cast("double")})
    found = metrics.information_coefficient(saw, ["model", "commodity", "year"])
    return rounded(found.where("n >= 3"), 8)


@query("model_wins", f"""
    WITH t AS (SELECT * FROM ({METRIC_SQL}) JOIN {DIRECTION} USING (model)),
    b AS (SELECT arg_min(model, rmse) AS best FROM t UNION ALL SELECT arg_min(model, mae) FROM t
          UNION ALL SELECT arg_min(model, mape) FROM t UNION ALL SELECT arg_max(model, r2) FROM t
          UNION ALL SELECT arg_max(model, directional_acc) FROM t),
    w AS (SELECT model, (SELECT count(*) FROM b WHERE best = model) AS wins FROM t)
    SELECT model, wins, row_number() OVER (ORDER BY wins DESC, model) = 1 AS recommended FROM w""")
def _(spark, d):
    return metrics.model_wins(table_of_metrics(spark, d), FIVE)


@query("residual_histogram", f"""
    WITH e AS (SELECT model, {ERR} AS x FROM forecasts), st AS (SELECT model, min(x) AS lo, max(x) AS hi FROM e GROUP BY model)
    SELECT model, bin, {s('lo + bin * ((hi - lo) / 30)', '"left"')}, {s('lo + (bin + 1) * ((hi - lo) / 30)', '"right"')}, count(*) AS n
    FROM (SELECT model, lo, hi, CAST(least(floor((x - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin FROM e JOIN st USING (model))
    GROUP BY model, bin, lo, hi""")
def _(spark, d):
    return single(profile.histogram_by(metrics.residuals(forecasts(spark, d)), ["model"], "residual", 30))


@query("residuals", f"SELECT model, commodity, idx, {t(ERR, 'residual')} FROM forecasts")
def _(spark, d):
    return tidy(metrics.residuals(forecasts(spark, d)).select("model", "commodity", "idx", "residual"))


@query("improvement", f"""
    WITH t AS ({METRIC_SQL}), b AS (SELECT max(r2) AS v, arg_max(model, r2) AS m FROM t WHERE model <> 'sma_7')
    SELECT {r('t.r2', 6, 'r2_model')}, b.m AS best_base, {r('b.v', 6, 'r2_base')}, {r('t.r2 - b.v', 6, 'gain')}
    FROM t, b WHERE t.model = 'sma_7'""")
def _(spark, d):
    table = metrics.metric_table(forecasts(spark, d), {"r2": metrics.r2()})
    return rounded(metrics.improvement(table, "sma_7"), 6)


def history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training-history shaped table: one epoch per year of forecasts."""
    return forecasts(spark, sf_dir).groupBy("model", (F.year("date") - 1994).alias("epoch")).agg(
        F.avg(F.pow(metrics.error(), 2)).alias("loss"), F.avg(F.abs(metrics.error())).alias("val_loss"))


HISTORY_SQL = f"""SELECT model, CAST(year(date) - 1994 AS INT) AS epoch, avg({ERR} ** 2) AS loss, avg(abs{ERR}) AS val_loss
    FROM forecasts GROUP BY 1, 2"""


@query("best_epoch", f"""
    WITH h AS ({HISTORY_SQL}), b AS (SELECT model, arg_min(epoch, val_loss) AS epoch, min(val_loss) AS val_loss,
                                            count(*) AS epochs FROM h GROUP BY model)
    SELECT model, epoch, epochs, {s('val_loss')}, model = (SELECT arg_min(model, val_loss) FROM b) AS is_best FROM b""")
def _(spark, d):
    return single(metrics.best_epoch(history_table(spark, d)))


@query("learning_curves", f"SELECT model, epoch, {s('loss')}, {s('val_loss')} FROM ({HISTORY_SQL}) ORDER BY model, epoch")
def _(spark, d):
    return single(profile.learning_curves(history_table(spark, d)))


# --- ensembles -------------------------------------------------------------------------

@query("ensemble_average", f"""
    SELECT commodity, idx, {s('max(y_true)', 'y_true')}, {s('avg(y_pred)', 'y_pred')} FROM forecasts GROUP BY commodity, idx""")
def _(spark, d):
    return single(ensemble.ensemble_average(forecasts(spark, d), KEYS))


VAL = "(SELECT * FROM forecasts WHERE date < DATE '1999-01-01')"
WEIGHTS = f"""(SELECT model, mse, (1 / mse) / sum(1 / mse) OVER () AS weight
    FROM (SELECT model, avg({ERR} ** 2) AS mse FROM {VAL} GROUP BY model))"""


def validation(df: DataFrame) -> DataFrame:
    return df.where(F.col("date") < F.lit("1999-01-01").cast("date"))


@query("ensemble_weights", f"SELECT model, {s('mse')}, {r('weight', 8)} FROM {WEIGHTS}")
def _(spark, d):
    return rounded(single(ensemble.ensemble_weights(validation(forecasts(spark, d))), ["mse"]), 8, ["weight"])


@query("ensemble_weighted", f"""
    SELECT commodity, idx, {s('max(y_true)', 'y_true')}, {s('sum(weight * y_pred) / sum(weight)', 'y_pred')}
    FROM forecasts JOIN {WEIGHTS} USING (model) WHERE date >= DATE '1999-01-01' GROUP BY commodity, idx""")
def _(spark, d):
    rows = forecasts(spark, d)
    test = rows.where(F.col("date") >= F.lit("1999-01-01").cast("date"))
    return single(ensemble.combine(test, "weighted", KEYS, ensemble.ensemble_weights(validation(rows))))


@query("ensemble_topn", f"""
    WITH top AS (SELECT model FROM ({METRIC_SQL}) ORDER BY r2 DESC, model LIMIT 2)
    SELECT model, commodity, idx, {s('y_pred')} FROM forecasts WHERE model IN (SELECT model FROM top)""")
def _(spark, d):
    rows = forecasts(spark, d)
    scores = metrics.metric_table(rows, {"r2": metrics.r2()})
    return single(ensemble.ensemble_topn(rows, scores, 2).select("model", "commodity", "idx", "y_pred"))


@query("repair_predictions", f"""
    WITH h AS (SELECT model, commodity, idx, CASE WHEN idx % 11 <> 0 THEN y_pred END AS y_pred FROM forecasts)
    SELECT model, commodity, idx, {s('coalesce(y_pred, avg(y_pred) OVER (PARTITION BY model))', 'y_pred')} FROM h""")
def _(spark, d):
    spoiled = F.when(F.col("idx") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("y_pred"))
    rows = forecasts(spark, d).select("model", "commodity", "idx", spoiled.alias("y_pred"))
    return single(ensemble.repair_predictions(rows))


@query("ensemble_stacking")
def _(spark, d):
    rows = forecasts(spark, d)
    wide = ensemble.stack_predictions(rows, MODELS, [*KEYS, "date", "y_true"])
    model = ensemble.fit_stacking(validation(wide), MODELS)
    test = wide.where(F.col("date") >= F.lit("1999-01-01").cast("date"))
    return ensemble.apply_stacking(model, test, MODELS)


@query("hybrid_flow")
def _(spark, d):
    return hybrid_flow(forecasts(spark, d), KEYS, F.col("date") < F.lit("1999-01-01").cast("date"), 2)[0]


# --- forecasters -----------------------------------------------------------------------

@query("holt_winters")
def _(spark, d):
    return forecasters.holt_winters(daily_filled(spark, d), KEY, periods=14)


@query("forecast_interval", f"""
    WITH sd AS (SELECT model, commodity, stddev_pop{ERR} AS resid_std FROM forecasts GROUP BY model, commodity)
    SELECT model, commodity, idx, {s('resid_std')}, {t('y_pred - 1.645 * resid_std', '"lower"')}, {t('y_pred + 1.645 * resid_std', '"upper"')}
    FROM forecasts JOIN sd USING (model, commodity)""")
def _(spark, d):
    rows = forecasts(spark, d)
    spread = forecasters.residual_std(rows, ["model", "commodity"])
    out = forecasters.forecast_interval(rows.join(spread, ["model", "commodity"]), 0.10, "y_pred")
    return tidy(out.select("model", "commodity", "idx", "resid_std", "lower", "upper"))


@query("ar_select")
def _(spark, d):
    return forecasters.ar_select(daily_filled(spark, d), KEY)


@query("ar_forecast")
def _(spark, d):
    rows = daily_filled(spark, d)
    return forecasters.ar_forecast(rows, forecasters.ar_select(rows, KEY), KEY, 14)


@query("trend_seasonal_fit")
def _(spark, d):
    return forecasters.trend_seasonal_fit(daily_filled(spark, d), KEY, mode="mul")


@query("trend_seasonal_conditions", f"""
    SELECT commodity, count(*) AS n, CAST(0 AS DOUBLE) AS mean_residual, CAST(0 AS DOUBLE) AS trend_residual
    FROM daily_filled GROUP BY commodity""")
def _(spark, d):
    """First-order conditions of the fit: residuals are orthogonal to the unpenalised level and slope."""
    rows = daily_filled(spark, d)
    parts = forecasters.trend_seasonal_forecast(rows, KEY, 0, include_history=True)
    both = rows.join(parts.select(*KEY, "date", "yhat"), [*KEY, "date"])
    share = (F.col("price") - F.col("yhat")) / 1e5
    day = F.datediff("date", F.lit("1992-01-01").cast("date")) / 1e4
    return rounded(both.groupBy(*KEY).agg(
        F.count(share).alias("n"), F.avg(share).alias("mean_residual"), F.avg(share * day).alias("trend_residual")), 6)


@query("forecast_components")
def _(spark, d):
    return forecasters.trend_seasonal_forecast(daily_filled(spark, d), KEY, 30, include_history=True)


@query("future_frame", """
    SELECT commodity, CAST(unnest(generate_series(min(date), max(date) + 30, INTERVAL 1 DAY)) AS DATE) AS date
    FROM prices_orders GROUP BY commodity""")
def _(spark, d):
    return future_frame(prices_orders(spark, d), KEY, 30, include_history=True)


def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-week windows per commodity on prices in units of the whole table's range."""
    rows = scaling.scale(daily_filled(spark, sf_dir), ["price"], "minmax")
    # Day grain: one row per day, so the index needs no split by day.
    day = F.row_number().over(Window.partitionBy(*KEY).orderBy("date")) - 1
    rows = rows.withColumn("idx", day.cast("long"))
    wins = sequences.sequence_windows(rows, KEY, ["price"], "price", 14)
    # The fit reads its windows more than once.
    return materialize(sequences.chrono_split(wins, KEY), "windows")


@query("window_regressor")
def _(spark, d):
    wins = split_windows(spark, d)
    model = forecasters.fit_window_regressor(wins.where("split = 'train'"))
    scored = model.transform(forecasters.flat_vectors(wins.where("split = 'test'")))
    return scored.select("commodity", "idx", "label", "y_pred")


def _regressor_query(kind: str) -> None:
    @query(f"window_regressor_{kind}")
    def _(spark, d):
        wins = split_windows(spark, d)
        model = forecasters.fit_window_regressor(wins.where("split = 'train'"), kind)
        scored = model.transform(forecasters.flat_vectors(wins.where("split = 'test'")))
        return scored.select("commodity", "idx", "label", "y_pred")


_regressor_query("huber")
_regressor_query("gbt")


@query("batch_score")
def _(spark, d):
    wins = split_windows(spark, d)
    path = f"{shared_folder(spark)}/window-regressor-{uuid.uuid4().hex}"
    forecasters.fit_window_regressor(wins.where("split = 'train'")).write().save(path)
    shift, size = scaling.minmax_stats(daily_filled(spark, d), ["price"])["price"]
    test = wins.where("split = 'test'").drop("split")
    return forecasters.batch_score(path, test, shift, size)


# --- chart tables ----------------------------------------------------------------------

@query("error_by_quarter", f"""
    WITH p AS (SELECT model, commodity, abs{ERR} AS e, row_number() OVER ({FW}) - 1 AS place,
                      count(*) OVER (PARTITION BY model, commodity) AS n FROM forecasts)
    SELECT model, commodity, CAST(1 + CAST(place >= n // 4 AS INT) + CAST(place >= n // 2 AS INT) + CAST(place >= 3 * n // 4 AS INT) AS INT) AS quarter, count(*) AS n,
           {s('avg(e)', 'mean_abs_error')}, {s('max(e)', 'max_abs_error')} FROM p GROUP BY 1, 2, 3""")
def _(spark, d):
    rows = series_index(forecasts(spark, d), ["model", "commodity"], "date", "idx", idx="place")
    return single(profile.error_by_quarter(rows, ["model", "commodity"]))


@query("error_ecdf", f"""
    SELECT model, {s('e', 'abs_error')}, place, {r('place / n', 8, 'cumulative')} FROM (
      SELECT model, abs{ERR} AS e, row_number() OVER (PARTITION BY model ORDER BY abs{ERR}) AS place,
             CAST(count(*) OVER (PARTITION BY model) AS DOUBLE) AS n FROM forecasts)""")
def _(spark, d):
    return rounded(single(profile.error_ecdf(forecasts(spark, d)), ["abs_error"]), 8, ["cumulative"])


@query("error_boxplot", f"""
    WITH e AS (SELECT model, {ERR} AS e FROM forecasts),
    q AS (SELECT model, quantile_cont(e, 0.25) AS q25, quantile_cont(e, 0.5) AS q50, quantile_cont(e, 0.75) AS q75 FROM e GROUP BY model)
    SELECT model, {t('q25', 'q25', 4)}, {t('q50', 'q50', 4)}, {t('q75', 'q75', 4)},
      {t('min(CASE WHEN inside THEN e END)', 'whisker_low', 4)}, {t('max(CASE WHEN inside THEN e END)', 'whisker_high', 4)},
      CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers, count(*) AS n
    FROM (SELECT *, e BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM e JOIN q USING (model))
    GROUP BY model, q25, q50, q75""")
def _(spark, d):
    return tidy(profile.error_boxplot(forecasts(spark, d)), 4)


def _mm(c: str, down: bool) -> str:
    score = f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-8)"
    return f"1 - {score}" if down else score


@query("heatmap_scores", f"""
    WITH res AS ({RESULTS_SQL})
    SELECT model, {s('rmse')}, {s('mae')}, {s('mape')}, {r('r2', 6)}, {r(_mm('rmse', True), 6, 'rmse_score')},
      {r(_mm('mae', True), 6, 'mae_score')}, {r(_mm('mape', True), 6, 'mape_score')}, {r(_mm('res.r2', False), 6, 'r2_score')}
    FROM res""")
def _(spark, d):
    rows = single(profile.heatmap_scores(results_table(spark, d)), ["rmse", "mae", "mape"])
    return rounded(rows, 6, ["r2", "rmse_score", "mae_score", "mape_score", "r2_score"])


@query("radar_scores", f"""
    WITH res AS (SELECT *, r2 / (params / 1e6 + 0.1) AS eff FROM ({RESULTS_SQL}))
    SELECT model, {r('params / 1e6', 6, 'params_m')}, {r(_mm('rmse', True), 6, 'rmse_score')}, {r(_mm('mae', True), 6, 'mae_score')},
      {r(_mm('mape', True), 6, 'mape_score')}, {r(_mm('r2', False), 6, 'r2_score')}, {r(_mm('eff', False), 6, 'efficiency')}
    FROM res""")
def _(spark, d):
    return rounded(profile.radar_scores(results_table(spark, d)), 6)


@query("qq_points")
def _(spark, d):
    return profile.qq_points(forecasts(spark, d))


@query("predictions_overlay", f"""
    SELECT commodity, idx, {s('max(y_true)', 'y_true')}, {', '.join(s(f"max(CASE WHEN model = '{m}' THEN y_pred END)", m) for m in MODELS)}
    FROM forecasts GROUP BY commodity, idx""")
def _(spark, d):
    return single(profile.predictions_overlay(forecasts(spark, d), MODELS, KEY))
