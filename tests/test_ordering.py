"""Skewed keys, ties and block borders against plain pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricefield.operators import ordering as o
from pricefield.operators import panel, sequences
from pricefield.operators.joins import attach


@pytest.fixture(scope="module")
def quotes():
    """900 rows; one (series, date) holds a third of them."""
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame({
        "k": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
        "date": pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 40, n), "D"),
        "row_id": rng.permutation(n) * 3 + 5,
        "x": np.round(rng.normal(0, 100, n), 1),
    })
    pdf.loc[: n // 3, ["k", "date"]] = ["a", pd.Timestamp("2020-01-17")]
    pdf.loc[pdf.index % 10 == 0, "x"] = 7.5
    pdf["date"] = pdf["date"].dt.date
    return pdf


@pytest.fixture(scope="module")
def df(spark, quotes):
    return spark.createDataFrame(quotes).repartition(5)


def ordered(quotes, series):
    out = quotes.sort_values([*series, "date", "row_id"]).reset_index(drop=True)
    out["idx"] = out.groupby(series).cumcount() if series else np.arange(len(out))
    return out


@pytest.mark.parametrize("series", [[], ["k"]])
@pytest.mark.parametrize("hot_rows", [7, 50, 10_000])
def test_series_index_with_crowded_dates(df, quotes, series, hot_rows):
    got = o.series_index(df, series, "date", "row_id", hot_rows=hot_rows).toPandas()
    want = ordered(quotes, series)
    merged = got.merge(want, on="row_id")
    assert len(got) == len(quotes)
    assert (merged["idx_x"] == merged["idx_y"]).all()


@pytest.mark.parametrize("block_rows", [29, 64, 5000])
def test_blocked_frames_equal_unblocked(df, quotes, block_rows):
    rows = df.withColumnRenamed("k", "commodity_clean").withColumn("price_log", F.col("x")).withColumn(
        "price_normalized", F.col("x"))
    got = panel.panel_rolling(rows, "commodity_clean", "row_id", block_rows=block_rows).toPandas()
    want = ordered(quotes, ["k"])
    for w in (7, 14, 30):
        roll = want.groupby("k")["x"].rolling(w, min_periods=1)
        want[f"ma_{w}"] = roll.mean().reset_index(level=0, drop=True)
        want[f"std_{w}"] = roll.std().reset_index(level=0, drop=True).fillna(0)
    merged = got.merge(want, on="row_id", suffixes=("", "_w"))
    assert len(merged) == len(quotes)
    for c in ("ma_7", "ma_30", "std_7", "std_14", "std_30"):
        np.testing.assert_allclose(merged[c], merged[f"{c}_w"], atol=1e-6)


@pytest.mark.parametrize("block_rows", [15, 100, 5000])
def test_windows_with_horizon(df, quotes, block_rows):
    rows = o.series_index(df, [], "date", "row_id")
    got = sequences.sequence_windows(rows, [], ["x", "row_id"], "x", 12, 3, block_rows=block_rows).toPandas()
    want = ordered(quotes, [])
    assert len(got) == len(want) - 12 - 3 + 1
    for _, row in got.iterrows():
        i = row["idx"]
        np.testing.assert_array_equal(np.array([list(v) for v in row["win"]]), want[["x", "row_id"]].iloc[i:i + 12])
        assert row["label"] == want["x"].iloc[i + 12 + 3 - 1]


def test_frame_longer_than_block_is_refused(df):
    with pytest.raises(ValueError):
        o.with_blocks(df.withColumn("idx", F.lit(0)), "idx", 10, block_rows=5)


@pytest.mark.parametrize("block_rows, fan", [(10, 2), (10, 1000), (77, 3), (5000, 1000)])
@pytest.mark.parametrize("series", [[], ["k"]])
def test_fill_rows_across_blocks(spark, quotes, block_rows, fan, series):
    holes = quotes.copy()
    want = ordered(holes, series)
    gap = (want["idx"] < 25) | (want["idx"] % 60 > 20)
    want["y"] = want["x"].where(~gap)
    src = spark.createDataFrame(want.replace({np.nan: None}).astype({"y": object}), "k string, date date, row_id long, x double, idx long, y double")
    got = o.fill_rows(src, series, "idx", ["y"], block_rows, fan).toPandas()
    assert len(got) == len(want)
    groups = want.groupby(series)["y"] if series else want["y"]
    filled = groups.ffill()
    want["f"] = filled
    want["f"] = want.groupby(series)["f"].bfill() if series else want["f"].bfill()
    merged = got.merge(want[["row_id", "f"]], on="row_id")
    np.testing.assert_array_equal(merged["y"], merged["f"])


def test_fill_rows_keeps_null_series(spark):
    src = spark.createDataFrame(
        [(None, i, 5.0 if i == 3 else None) for i in range(9)] + [("a", i, None) for i in range(3)], "k string, idx long, y double")
    got = o.fill_rows(src, ["k"], "idx", ["y"], 2, 2).toPandas()
    assert len(got) == 12
    assert (got[got["k"].isna()]["y"] == 5.0).all() and got[got["k"] == "a"]["y"].isna().all()


def test_fill_rows_windows_over_a_series_see_one_row_per_group(spark, quotes):
    src = spark.range(100).selectExpr("id AS idx", "if(id % 7 = 0, id, null) AS y")
    text = o.fill_rows(src, [], "idx", ["y"], 10, 2)._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in text.splitlines() if "Window [" in line and "_block" not in line.split("], [")[1]]
    assert wide and all("_group" in line for line in wide)


@pytest.mark.parametrize("hot_rows", [0, 200, 10_000])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_exact_quantiles_equal_pandas(df, quotes, by, hot_rows):
    probs = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.995, "f": 1.0}
    got = o.exact_quantiles(df, "x", probs, by, hot_rows).toPandas()
    assert len(got) == (3 if by else 1)
    for _, row in got.iterrows():
        part = quotes if not by else quotes[quotes["k"] == row["k"]]
        for name, p in probs.items():
            assert row[name] == pytest.approx(part["x"].quantile(p), abs=1e-9)


def test_quantiles_skip_missing(spark):
    src = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert o.quantile_values(src, "x", {"m": 0.5}) == {"m": 2.0}


def test_average_ranks_and_sorted_rows(df, quotes):
    pos = o.value_positions(df, ["k"], "x")
    ranks = pos.withColumn("r", o.average_rank()).toPandas()
    want = quotes.assign(r=quotes.groupby("k")["x"].rank()).drop_duplicates(["k", "x"])
    merged = ranks.merge(want, on=["k", "x"])
    assert len(merged) == len(want)
    np.testing.assert_allclose(merged["r_x"], merged["r_y"])
    rows = o.sorted_rows(pos, chunk=4).toPandas().sort_values(["k", "place"])
    assert len(rows) == len(quotes)
    for k, part in rows.groupby("k"):
        np.testing.assert_array_equal(part["x"], np.sort(quotes.loc[quotes["k"] == k, "x"]))
        np.testing.assert_array_equal(part["place"], np.arange(1, len(part) + 1))


def test_order_bucket_is_monotone(spark):
    values = sorted([-1e9, -5.0, -1.0001, -1.0, -1e-7, 0.0, 1e-300, 1e-7, 1.0, 1.0001, 5.0, 1e9, 1e300])
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", o.order_bucket("x").alias("b")).toPandas()
    assert got.sort_values("x")["b"].is_monotonic_increasing


def test_hash_batches_are_a_permutation(spark):
    rows = spark.range(1000).withColumnRenamed("id", "idx")
    got = sequences.window_batches(rows, 64, seed=5).toPandas()
    assert sorted(got["idx"]) == list(range(1000))
    assert sorted(got.groupby("batch_id").size()) == sorted([64] * 15 + [40])
    plain = sequences.window_batches(rows, 64).toPandas()
    assert (got.sort_values("idx")["batch_id"].to_numpy() != plain.sort_values("idx")["batch_id"].to_numpy()).any()


@pytest.mark.parametrize("limit", [0, 2, 100])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_by_broadcast_and_by_salt(df, quotes, limit, how):
    small = df.where("k <> 'c'").groupBy("k").agg(F.sum("x").alias("total"))
    got = attach(df, small, ["k"], how, limit=limit, salts=8).toPandas()
    assert df.sparkSession._jsc.getPersistentRDDs().isEmpty()
    want = quotes if how == "left" else quotes[quotes["k"] != "c"]
    assert len(got) == len(want)
    sums = quotes[quotes["k"] != "c"].groupby("k")["x"].sum()
    merged = got.set_index("row_id")["total"].reindex(want["row_id"])
    np.testing.assert_allclose(merged, want["k"].map(sums), equal_nan=True)


def test_crowded_date_is_spread_by_slice(df):
    rows = o.series_index(df, ["k"], "date", "row_id", hot_rows=50)
    text = rows._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in text.splitlines() if "Window [row_number()" in line)
    assert "_slice" in window
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "_slice" in line]
    assert wide, "rows are shuffled by slice, not by date alone"


def test_buckets_of_infinite_values_are_the_outer_ones(spark):
    values = [float("-inf"), -1.7e308, -2.0, 0.0, 5e-324, 3.0, 1.7e308, float("inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", o.order_bucket("v").alias("b")).orderBy("v")
    buckets = [r["b"] for r in rows.collect()]
    assert buckets == sorted(set(buckets))
