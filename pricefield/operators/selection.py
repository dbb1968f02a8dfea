"""Feature ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arithmetic import nan_to_null


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(feature, position, score) with score = |Pearson|; flat features are dropped.

    All pairs are taken in one aggregation: co-moments per pair, not one job per feature.
    """
    aggs = []
    for i, c in enumerate(features):
        both = F.col(c).isNotNull() & F.col(target).isNotNull()
        x = F.when(both, F.col(c).cast("double"))
        y = F.when(both, F.col(target).cast("double"))
        aggs += [
            F.covar_pop(x, y).alias(f"c_{i}"), F.stddev_pop(x).alias(f"x_{i}"), F.stddev_pop(y).alias(f"y_{i}"),
            F.min(x).alias(f"lo_{i}"), F.max(x).alias(f"hi_{i}"),
        ]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(features):
        r = F.try_divide(F.col(f"c_{i}"), F.col(f"x_{i}") * F.col(f"y_{i}"))
        score = F.when(F.col(f"lo_{i}") < F.col(f"hi_{i}"), F.abs(nan_to_null(r)))
        rows.append(F.struct(F.lit(c).alias("feature"), F.lit(i).alias("position"), score.alias("score")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").where("score IS NOT NULL")


def select_by_corr(df: DataFrame, features: Sequence[str], target: str, n: int = 50) -> DataFrame:
    scores = target_correlations(df, features, target)
    return scores.orderBy(F.desc("score"), "position").limit(n).select("feature", "score")


def select_features(
    df: DataFrame, features: Sequence[str], target: str, n: int = 50, method: str = "correlation"
) -> list[str]:
    if method == "first":
        return list(features)[:n]
    if method != "correlation":
        raise ValueError(f"unknown selection method: {method}")
    return [r["feature"] for r in select_by_corr(df, features, target, n).collect()]


def rank_importance(df: DataFrame, n: int = 20) -> DataFrame:
    """Top rows of (feature, importance)."""
    return df.orderBy(F.desc("importance"), "feature").limit(n)
