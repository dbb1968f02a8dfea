"""End-to-end flows built from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import number
from ..functions.text import strict_date
from ..operators import cleaning, daily, ensemble, features, forecasters, metrics, scaling, selection, sequences
from ..operators.ordering import fill_rows, series_index
from ..operators.profile import rank_results
from ..sources.adapters import dedup_quotes, union_sources
from ..sources.files import materialize
from ..sources.schemas import date_column, normalize_header, rename_escaped

PRICE_COLUMNS = ["min_price", "max_price", "modal_price"]


@dataclass
class FlowConfig:
    """Parameters of the modular flow."""

    commodity: str | None = None
    state: str | None = None
    market: str | None = None
    method: str = "mean"
    length: int = 30
    horizon: int = 1
    train: float = 0.70
    val: float = 0.15
    scaler: str = "minmax"
    n_features: int = 50
    lags: list[int] = field(default_factory=lambda: list(features.LAGS))
    windows: list[int] = field(default_factory=lambda: list(features.WINDOWS))
    external: bool = True


def combine_sources(sources: Sequence[DataFrame], exact: bool = True) -> DataFrame:
    """Unified sources to one table without repeats and without extreme prices."""
    quotes = dedup_quotes(union_sources(sources))
    return cleaning.trim_quantiles(quotes, 0.005, 0.995, positive=True, exact=exact)


def preprocess_quotes(raw: DataFrame, tiebreak: str, config: FlowConfig = FlowConfig(), exact: bool = True) -> DataFrame:
    """Raw market quotes to typed, filtered, filled and fenced rows.

    The fill runs over all kept rows in date order, whatever their commodity.
    """
    rows = rename_escaped(normalize_header(raw))
    rows = rows.withColumn("date", strict_date(date_column(rows.columns)))
    rows = cleaning.filter_entity(rows, config.commodity, config.state, config.market)
    rows = rows.na.drop(subset=["date"])
    prices = [c for c in PRICE_COLUMNS if c in rows.columns]
    rows = rows.withColumns({c: number(c) for c in prices})
    rows = fill_rows(series_index(rows, [], "date", tiebreak, idx="_idx"), [], "_idx", prices).drop("_idx")
    return cleaning.fence_q01_q99(rows, prices, exact)


@dataclass
class Prepared:
    """Windows with a split, and what is needed to read forecasts back as prices."""

    windows: DataFrame
    features: list[str]
    shift: Column
    size: Column


def prepare_windows(quotes: DataFrame, series: Sequence[str], price: str, config: FlowConfig = FlowConfig()) -> Prepared:
    """Typed quotes to scaled look-back windows of the most telling features."""
    series = list(series)
    days = daily.gap_fill_linear(daily.aggregate_daily(quotes, series, price, config.method), series, price)
    made = features.all_features(days, series, price, config.lags, config.windows, config.external)
    # Selection, scaling and windows each read the features; they are computed once.
    made = materialize(made, "features")
    names = features.feature_names(made, series, price)
    picked = selection.select_features(made, names, price, config.n_features)
    stats = scaling.SCALERS[config.scaler](made, [price, *picked])
    scaled = made.withColumns({c: (F.col(c) - shift) / size for c, (shift, size) in stats.items()})
    day = F.row_number().over(Window.partitionBy(*series).orderBy("date")) - 1
    scaled = scaled.select(*series, day.cast("long").alias("idx"), price, *picked)
    wins = sequences.sequence_windows(scaled, series, [price, *picked], price, config.length, config.horizon)
    split = sequences.chrono_split(wins, series, train=config.train, val=config.val)
    return Prepared(materialize(split, "windows"), [price, *picked], *stats[price])


def fit_and_score(prepared: Prepared, kinds: Sequence[str] = ("ridge", "huber", "gbt")) -> tuple[dict[str, PipelineModel], DataFrame]:
    """One regressor per kind on the train windows; metrics on the test windows, in prices."""
    train = prepared.windows.where("split = 'train'")
    test = forecasters.flat_vectors(prepared.windows.where("split = 'test'"))
    models, scored = {}, None
    for kind in kinds:
        models[kind] = forecasters.fit_window_regressor(train, kind)
        back = {c: F.col(c) * prepared.size + prepared.shift for c in ("label", "y_pred")}
        out = models[kind].transform(test).withColumns(back).withColumnRenamed("label", "y_true")
        out = out.drop("features", "split").withColumn("model", F.lit(kind))
        scored = out if scored is None else scored.unionByName(out)
    series = [c for c in scored.columns if c not in ("idx", "y_true", "y_pred", "model")]
    return models, metrics.forecast_metrics(scored, series)


def hybrid_flow(forecasts: DataFrame, keys: Sequence[str], known: Column, n: int = 3, name: str = "hybrid") -> tuple[DataFrame, DataFrame]:
    """Base results, the n best models, a stacking model on them, and the table with the new row ranked again.

    `known` marks the rows on which models are ranked and the stacking model is fitted; the results are those of
    all other rows. Returns (results, the stacked forecasts). Rows that lack one of the n models are not stacked.
    """
    scores = {"rmse": metrics.rmse(), "mae": metrics.mae(), "mape": metrics.mape(), "r2": metrics.r2(), "n": F.count(F.lit(1))}
    fitted, rest = forecasts.where(known), forecasts.where(~known)
    best = [row["model"] for row in ensemble.top_models(metrics.metric_table(fitted, scores), n).collect()]  # n rows

    def stacked(rows: DataFrame) -> DataFrame:
        return ensemble.stack_predictions(rows, best, [*keys, "y_true"])

    learner = ensemble.fit_stacking(stacked(fitted), best)
    made = ensemble.apply_stacking(learner, stacked(rest), best)
    made = made.select(F.lit(name).alias("model"), *keys, "y_true", F.col("y_stack").alias("y_pred"))
    return rank_results(metrics.metric_table(rest, scores), metrics.metric_table(made, scores)), made
