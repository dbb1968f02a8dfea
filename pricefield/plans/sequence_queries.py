"""Row index, look-back windows, splits, folds, scaling and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import scaling, selection, sequences
from ..operators.forecasters import baseline_forecasts
from ..operators.metrics import error
from ..operators.ordering import series_index
from ..sources.views import daily_filled, prices_orders
from .registry import query, r, rounded, s, single

LENGTH = 60
GLOBAL = "row_number() OVER (ORDER BY date, row_id) - 1"
BY_NAME = "row_number() OVER (PARTITION BY commodity ORDER BY date, row_id) - 1"


def indexed(spark: SparkSession, sf_dir: str, series: list[str] | None = None) -> DataFrame:
    return series_index(prices_orders(spark, sf_dir), series or [], "date", "row_id")


@query("global_index", f"SELECT row_id, {GLOBAL} AS idx FROM prices_orders")
def _(spark, d):
    return indexed(spark, d).select("row_id", "idx")


@query("chrono_split", f"""
    WITH i AS (SELECT row_id, {GLOBAL} AS idx, count(*) OVER () AS n FROM prices_orders)
    SELECT row_id, idx, CASE WHEN idx < floor(n * 0.7::DOUBLE) THEN 'train' WHEN idx < floor(n * 0.85::DOUBLE) THEN 'val'
                             ELSE 'test' END AS split FROM i""")
def _(spark, d):
    return sequences.chrono_split(indexed(spark, d), n=prices_orders(spark, d).count()).select("row_id", "idx", "split")


def summed_windows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Windows reduced to one check row each: ends, sum, extremes."""
    first = F.transform("win", lambda v: v[0])
    size = F.size("win")
    return df.select(
        *keys, "idx", size.alias("length"), F.element_at(first, 1).alias("win_first"),
        F.element_at(first, -1).alias("win_last"),
        F.aggregate(first, F.lit(0.0), lambda a, v: a + v).alias("win_sum"),
        F.array_min(first).alias("win_min"), F.array_max(first).alias("win_max"), "label",
    )


def windows_sql(keys: str, part: str, length: int, horizon: int) -> str:
    w = f"OVER ({part} ORDER BY date, row_id ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING)"
    order = f"OVER ({part} ORDER BY date, row_id)"
    return f"""
    WITH i AS (SELECT {keys} row_number() {order} - 1 AS idx, CAST(count(*) {w} AS INT) AS length, first_value(price) {w} AS win_first,
        last_value(price) {w} AS win_last, sum(price) {w} AS win_sum, min(price) {w} AS win_min, max(price) {w} AS win_max,
        lead(price, {length + horizon - 1}) {order} AS label FROM prices_orders)
    SELECT {keys} idx, length, win_first, win_last, {r('win_sum', 2)}, win_min, win_max, label FROM i WHERE label IS NOT NULL"""


@query("sequence_windows", windows_sql("commodity,", "PARTITION BY commodity", 30, 3))
def _(spark, d):
    rows = indexed(spark, d, ["commodity"])
    wins = sequences.sequence_windows(rows, ["commodity"], ["price"], "price", 30, 3)
    return rounded(summed_windows(wins, ["commodity"]), 2, ["win_sum"])


@query("sequence_windows_global", windows_sql("", "", LENGTH, 1))
def _(spark, d):
    wins = sequences.sequence_windows(indexed(spark, d), [], ["price"], "price", LENGTH)
    return rounded(summed_windows(wins, []), 2, ["win_sum"])


@query("window_batches", f"""
    WITH i AS (SELECT {GLOBAL} AS idx, lead(price, 60) OVER (ORDER BY date, row_id) AS label FROM prices_orders)
    SELECT idx, label, idx // 256 AS batch_id FROM i WHERE label IS NOT NULL""")
def _(spark, d):
    wins = sequences.sequence_windows(indexed(spark, d), [], ["price"], "price", LENGTH)
    return sequences.window_batches(wins, 256).select("idx", "label", "batch_id")


@query("window_batches_shuffled", f"""
    WITH i AS (SELECT {GLOBAL} AS idx, lead(price, 60) OVER (ORDER BY date, row_id) AS label FROM prices_orders),
    n AS (SELECT count(*) AS n FROM i WHERE label IS NOT NULL)
    SELECT unnest(range(0, (n + 255) // 256)) AS batch_id, least(256, n - unnest(range(0, (n + 255) // 256)) * 256) AS n, TRUE AS mixed FROM n""")
def _(spark, d):
    """Shuffled batches: all of the full size but the last, and none a run of neighbours."""
    wins = sequences.sequence_windows(indexed(spark, d), [], ["price"], "price", LENGTH)
    dealt = sequences.window_batches(wins.select("idx"), 256, seed=7).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), (F.max("idx") - F.min("idx")).alias("_span"))
    return dealt.select("batch_id", "n", ((F.col("_span") >= F.col("n")) | (F.col("n") < 3)).alias("mixed"))


@query("cv_folds", f"""
    WITH i AS (SELECT row_id, {GLOBAL} AS idx, count(*) OVER () AS n FROM prices_orders),
    f AS (SELECT CAST(unnest(range(5)) AS INT) AS fold),
    x AS (SELECT idx, row_id, fold, CASE WHEN idx < (n // 6) * (fold + 1) THEN 'train'
            WHEN idx >= (n // 6) * (fold + 1) + 10 AND idx < least((n // 6) * (fold + 2) + 10, n) THEN 'test' END AS role
          FROM i CROSS JOIN f)
    SELECT row_id, idx, fold, role FROM x WHERE role IS NOT NULL""")
def _(spark, d):
    n = prices_orders(spark, d).count()
    return sequences.cv_folds(indexed(spark, d), 5, gap=10, n=n).select("row_id", "idx", "fold", "role")


@query("cv_folds_sized", f"""
    WITH i AS (SELECT row_id, {GLOBAL} AS idx, count(*) OVER () AS n FROM prices_orders),
    f AS (SELECT CAST(unnest(range(6)) AS INT) AS fold),
    x AS (SELECT idx, row_id, fold, CASE WHEN idx < 2000 + fold * (n // 7) THEN 'train'
            WHEN idx >= 2000 + fold * (n // 7) + 5 AND idx < 2000 + (fold + 1) * (n // 7) + 5 THEN 'test' END AS role
          FROM i CROSS JOIN f WHERE 2000 + (fold + 1) * (n // 7) + 5 <= n)
    SELECT row_id, idx, fold, role FROM x WHERE role IS NOT NULL""")
def _(spark, d):
    n = prices_orders(spark, d).count()
    folds = sequences.cv_folds_sized(indexed(spark, d), 6, gap=5, min_train=2000, n=n)
    return folds.select("row_id", "idx", "fold", "role")


@query("cv_summary", f"""
    WITH f AS (SELECT model, idx, y_true, y_pred FROM forecasts),
    x AS (SELECT f.*, k.fold, (SELECT max(idx) + 1 FROM f) // 6 AS size FROM f CROSS JOIN (SELECT unnest(range(5)) AS fold) k),
    sc AS (SELECT model, fold, avg(abs(y_true - y_pred)) AS val_mae, avg((y_true - y_pred) ** 2) AS val_mse FROM x
           WHERE idx >= size * (fold + 1) AND idx < least(size * (fold + 2), (SELECT max(idx) + 1 FROM f)) GROUP BY model, fold)
    SELECT model, 'val_mae' AS metric, {s('avg(val_mae)', 'mean')}, {s('stddev_pop(val_mae)', 'std')} FROM sc GROUP BY model
    UNION ALL SELECT model, 'val_mse', {s('avg(val_mse)', 'mean')}, {s('stddev_pop(val_mse)', 'std')} FROM sc GROUP BY model""")
def _(spark, d):
    rows = baseline_forecasts(daily_filled(spark, d), ["commodity"])
    n = 1 + rows.agg(F.max("idx")).first()[0]
    test = sequences.cv_folds(rows, 5, n=n).where("role = 'test'")
    scores = test.groupBy("model", "fold").agg(
        F.avg(F.abs(error())).alias("val_mae"), F.avg(F.pow(error(), 2)).alias("val_mse"))
    return single(sequences.cv_summary(scores, ["val_mae", "val_mse"], ["model"]))


_NW = "OVER (ORDER BY date, row_id ROWS BETWEEN CURRENT ROW AND 29 FOLLOWING)"


@query("window_instance_norm", f"""
    WITH i AS (SELECT {GLOBAL} AS idx, price, avg(price) {_NW} AS m, var_pop(price) {_NW} AS v,
        min(price) {_NW} AS lo, max(price) {_NW} AS hi, last_value(price) {_NW} AS z,
        lead(price, 30) OVER (ORDER BY date, row_id) AS label FROM prices_orders)
    SELECT idx, {r('(price - m) / (sqrt(v + 1e-5) + 1e-5)', 6, 'norm_first')}, {r('(z - m) / (sqrt(v + 1e-5) + 1e-5)', 6, 'norm_last')},
      {r('(lo - m) / (sqrt(v + 1e-5) + 1e-5)', 6, 'norm_min')}, {r('(hi - m) / (sqrt(v + 1e-5) + 1e-5)', 6, 'norm_max')}
    FROM i WHERE label IS NOT NULL""")
def _(spark, d):
    wins = sequences.sequence_windows(indexed(spark, d), [], ["price"], "price", 30)
    norm = F.transform(sequences.instance_norm(F.col("win"), 1), lambda v: v[0])
    rows = wins.select("idx", norm.alias("z"))
    return rounded(rows.select(
        "idx", F.element_at("z", 1).alias("norm_first"), F.element_at("z", -1).alias("norm_last"),
        F.array_min("z").alias("norm_min"), F.array_max("z").alias("norm_max")), 6)


@query("window_patches", f"""
    WITH i AS (SELECT *, {GLOBAL} AS idx, lead(price, 60) OVER (ORDER BY date, row_id) AS label FROM prices_orders),
    p AS (SELECT idx, label, unnest(range(6)) AS patch FROM i WHERE label IS NOT NULL),
    v AS (SELECT idx, price AS patch_first, sum(price) OVER (ORDER BY idx ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING) AS total,
                 lead(price, 15) OVER (ORDER BY idx) AS patch_last FROM i)
    SELECT p.idx, CAST(patch AS INT) AS patch, v.patch_first, v.patch_last, {r('total', 2, 'patch_sum')}, 16 AS patch_len
    FROM p JOIN v ON v.idx = p.idx + 8 * p.patch""")
def _(spark, d):
    wins = sequences.sequence_windows(indexed(spark, d), [], ["price"], "price", LENGTH)
    rows = wins.select("idx", F.posexplode(sequences.patches(F.col("win"))).alias("patch", "p"))
    rows = rows.select(
        "idx", "patch", F.element_at("p", 1)[0].alias("patch_first"), F.element_at("p", -1)[0].alias("patch_last"),
        F.aggregate("p", F.lit(0.0), lambda a, v: a + v[0]).alias("patch_sum"), F.size("p").alias("patch_len"))
    return rounded(rows, 2, ["patch_sum"])


# --- scaling ---------------------------------------------------------------------------

COLS = ["price", "size"]
BASE = "SELECT row_id, price, CAST(length(commodity) AS DOUBLE) AS size FROM prices_orders"


def scalable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices_orders(spark, sf_dir).select("row_id", "price", F.length("commodity").cast("double").alias("size"))


@query("scale_minmax", f"""
    SELECT row_id, {', '.join(r(f'({c} - min({c}) OVER ()) / coalesce(nullif(max({c}) OVER () - min({c}) OVER (), 0), 1)', 8, c) for c in COLS)}
    FROM ({BASE})""")
def _(spark, d):
    return rounded(scaling.scale(scalable(spark, d), COLS, "minmax"), 8)


@query("scale_standard", f"""
    SELECT row_id, {', '.join(r(f'({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)', 8, c) for c in COLS)}
    FROM ({BASE})""")
def _(spark, d):
    return rounded(scaling.scale(scalable(spark, d), COLS, "standard"), 8)


@query("scale_robust", f"""
    WITH q AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}, coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) AS w_{c}' for c in COLS)}
               FROM ({BASE}))
    SELECT row_id, {', '.join(r(f'({c} - m_{c}) / w_{c}', 8, c) for c in COLS)} FROM ({BASE}), q""")
def _(spark, d):
    return rounded(scaling.scale(scalable(spark, d), COLS, "robust"), 8)


@query("unscale_target", f"SELECT row_id, {s('price')} FROM prices_orders")
def _(spark, d):
    rows = scalable(spark, d)
    stats = scaling.minmax_stats(rows, ["price"])
    scaled = scaling.scale(rows, ["price"], "minmax")
    return single(scaled.select("row_id", scaling.unscale("price", *stats["price"]).alias("price")))


# --- selection -------------------------------------------------------------------------

def small_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    df, f = daily_filled(spark, sf_dir), ft.Frames(["commodity"])
    made = {**ft.sma_columns(f, "price"), **ft.std_columns(f, "price")}
    rows = df.withColumns(ft.past_columns(f, "price") | made).withColumns(ft.lag_columns())
    return rows, [*ft.lag_columns(), *made]


_MADE = {f"price_lag_{k}": f"lag(price, {k}) OVER (PARTITION BY commodity ORDER BY date)" for k in ft.LAGS}
for _k in ft.WINDOWS:
    _frame = f"OVER (PARTITION BY commodity ORDER BY date ROWS BETWEEN {_k - 1} PRECEDING AND CURRENT ROW)"
    _MADE[f"sma_{_k}"] = f"avg(price) {_frame}"
    _MADE[f"rolling_std_{_k}"] = f"stddev_samp(price) {_frame}"
MADE_SQL = f"SELECT commodity, date, price, {', '.join(f'{e} AS {n}' for n, e in _MADE.items())} FROM daily_filled"


@query("select_by_corr", f"""
    WITH m AS ({MADE_SQL}), c AS ({' UNION ALL '.join(f"SELECT '{n}' AS feature, abs(corr({n}, price)) AS score FROM m" for n in _MADE)})
    SELECT feature, {r('score', 7)} FROM c ORDER BY c.score DESC LIMIT 10""")
def _(spark, d):
    rows, names = small_features(spark, d)
    return rounded(selection.select_by_corr(rows, names, "price", 10), 7)


@query("rank_importance", f"""
    WITH m AS ({MADE_SQL}), c AS ({' UNION ALL '.join(f"SELECT '{n}' AS feature, abs(covar_pop({n}, price)) AS importance FROM m" for n in _MADE)})
    SELECT feature, {s('importance')} FROM c ORDER BY c.importance DESC, feature LIMIT 5""")
def _(spark, d):
    rows, names = small_features(spark, d)
    table = rows.agg(*[F.abs(F.covar_pop(n, "price")).alias(n) for n in names])
    return single(selection.rank_importance(table.unpivot([], names, "feature", "importance"), 5))
