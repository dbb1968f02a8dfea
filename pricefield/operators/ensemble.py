"""Combining forecasts. Input: long table (model, keys..., y_true, y_pred)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import nan_to_null

KEYS = ("idx",)


def stack_predictions(df: DataFrame, models: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """One column per model, names sorted; rows some model lacks hold NULL there."""
    pivot = df.groupBy(*keys).pivot("model", sorted(models))
    return pivot.agg(F.first("y_pred"))


def ensemble_average(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.max("y_true").alias("y_true"), F.avg("y_pred").alias("y_pred"))


def ensemble_weights(df: DataFrame) -> DataFrame:
    """(model, mse, weight), weight = share of 1/mse."""
    mse = df.groupBy("model").agg(F.avg((F.col("y_pred") - F.col("y_true")) ** 2).alias("mse"))
    inverse = F.try_divide(F.lit(1.0), F.col("mse"))
    # A table of one row per model.
    return mse.withColumn("weight", inverse / F.sum(inverse).over(Window.partitionBy()))


def ensemble_weighted(df: DataFrame, weights: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    w = F.broadcast(weights.select("model", "weight"))  # one row per model
    rows = df.join(w, "model")
    weight = F.when(F.col("y_pred").isNotNull(), F.col("weight"))
    mean = F.try_divide(F.sum(weight * F.col("y_pred")), F.sum(weight))
    return rows.groupBy(*keys).agg(F.max("y_true").alias("y_true"), mean.alias("y_pred"))


def top_models(scores: DataFrame, n: int = 3) -> DataFrame:
    """The n models of highest r2; a missing score counts as 0, ties by name."""
    ranked = scores.select("model", F.coalesce("r2", F.lit(0.0)).alias("r2"))
    return ranked.orderBy(F.desc("r2"), "model").limit(n)


def ensemble_topn(df: DataFrame, scores: DataFrame, n: int = 3) -> DataFrame:
    return df.join(F.broadcast(top_models(scores, n).select("model")), "model", "left_semi")


def repair_predictions(df: DataFrame) -> DataFrame:
    """A missing forecast becomes that model's mean forecast."""
    rows = df.withColumn("y_pred", nan_to_null("y_pred"))
    means = rows.groupBy("model").agg(F.avg("y_pred").alias("_mean"))
    fixed = F.coalesce("y_pred", "_mean")
    return rows.join(F.broadcast(means), "model").withColumn("y_pred", fixed).drop("_mean")


def fit_stacking(stacked: DataFrame, models: Sequence[str], ridge: float = 1e-3):
    """Linear meta-learner on stacked forecasts (a frame from stack_predictions + y_true)."""
    rows = stacked.na.drop(subset=[*models, "y_true"])
    vectors = VectorAssembler(inputCols=sorted(models), outputCol="features").transform(rows)
    learner = LinearRegression(
        featuresCol="features", labelCol="y_true", predictionCol="y_stack", regParam=ridge, solver="normal"
    )
    return learner.fit(vectors.select("features", "y_true"))


def apply_stacking(model, stacked: DataFrame, models: Sequence[str]) -> DataFrame:
    rows = stacked.na.drop(subset=list(models))
    vectors = VectorAssembler(inputCols=sorted(models), outputCol="features").transform(rows)
    return model.transform(vectors).drop("features")


def combine(df: DataFrame, method: str, keys: Sequence[str] = KEYS, weights: DataFrame | None = None) -> DataFrame:
    if method == "average":
        return ensemble_average(df, keys)
    if method == "weighted":
        return ensemble_weighted(df, weights if weights is not None else ensemble_weights(df), keys)
    raise ValueError(f"unknown ensemble method: {method}")
