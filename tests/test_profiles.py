"""Sketches and grouped histograms against plain counts."""

import numpy as np
import pandas as pd

from pricefield.operators import profile


def test_stored_sketches_merge(spark, tmp_path):
    rows = spark.range(200_000).selectExpr("id % 40 AS day", "id % 50000 AS wide", "id % 7 AS small", "CAST(NULL AS STRING) AS none")
    cols = ["wide", "small", "none"]
    profile.distinct_sketches(rows, ["day"], cols).write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    assert stored.count() == 40
    got = {r["column"]: r["n_unique"] for r in profile.merged_distinct_counts(stored, cols).collect()}
    assert abs(got["wide"] - 50_000) < 0.0325 * 50_000
    assert (got["small"], got["none"]) == (7, 0)
    by_day = profile.merged_distinct_counts(stored, ["small"], ["day"]).collect()
    want = rows.groupBy("day").agg({"small": "count"}).count()
    assert len(by_day) == want and all(r["n_unique"] == 7 for r in by_day)


def test_histogram_per_group(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 500)
    rows = [("a", float(v)) for v in x] + [("flat", 3.0)] * 4 + [("a", None)]
    got = profile.histogram_by(spark.createDataFrame(rows, "m string, x double"), ["m"], "x", 30).toPandas()
    a = got[got["m"] == "a"].set_index("bin")["n"].reindex(range(30), fill_value=0)
    assert a.tolist() == np.histogram(x, 30)[0].tolist()
    flat = got[got["m"] == "flat"]
    assert flat["n"].tolist() == [4] and flat["left"].iloc[0] <= 3.0 <= flat["right"].iloc[0]
    empty = profile.histogram_by(spark.createDataFrame([], "m string, x double"), ["m"], "x")
    assert isinstance(empty.toPandas(), pd.DataFrame) and empty.count() == 0
