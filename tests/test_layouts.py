"""CSV by header, and the answers on rows with holes and missing values."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from pricefield.operators import features, forecasters, metrics, ordering, profile
from pricefield.sources import adapters, files, layouts, schemas

DAY = dt.date(2020, 1, 5)


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder / name)


def test_columns_are_found_by_name_in_any_order(spark, tmp_path):
    path = put(tmp_path / "a b", "q.csv", "price,date,commodity\n5,2020-01-01,Rice\n")
    row = files.read_csv(spark, path, schemas.QUOTES).first()
    assert (row["date"], row["price"], row["commodity"], row["source"]) == (dt.date(2020, 1, 1), 5.0, "Rice", None)


def test_files_of_several_layouts_make_one_table(spark, tmp_path):
    d = tmp_path / "many"
    put(d, "1.csv", "Date,Price,Commodity\n2020-01-01,1,café\n2020-01-02,2\n2020-01-03,3,x,too long\n")
    put(d, "2.csv", "commodity;date;price;\"a;b\"\nblé;2020-01-04;4,5;\"x;y\"\n", "latin-1")
    put(d, "3.csv", "﻿Commodity\tPrice\tDate\nöl\t6\t2020-01-05\n")
    put(d, "4.csv", "price|date\n7|2020-01-06\n")
    put(d, "5.csv", "")
    put(d, "6.csv", "date,price,commodity\n")
    put(d, "7.csv", "date,price,commodity\n2020-01-07,8,тест\n", "utf-16")
    got = layouts.read_csv_by_header(spark, str(d), ["commodity", "date", "price"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [
        ("café", "2020-01-01", "1"), (None, "2020-01-02", "2"), ("blé", "2020-01-04", "4,5"), ("öl", "2020-01-05", "6"),
        (None, "2020-01-06", "7"), ("тест", "2020-01-07", "8")]
    assert layouts.read_csv_by_header(spark, str(d)).columns == ["a;b", "commodity", "date", "price"]


@pytest.mark.parametrize("name, text", [
    ("mandi", "Modal Price,Commodity,Arrival_Date,State\n9,Rïce,05-01-2020,X\n"),
    ("wfp_india", "price,commodity,date\n#item,#name,#date\n9,Rïce,2020-01-05\n"),
    ("kalimati", "Average;Commodity;Date\n9;Rïce;2020-01-05\n"),
    ("long_futures", "close,symbol,date\n9,Rïce,2020-01-05\n"),
    ("wide_futures", "Rïce,Date\n9,2020-01-05\n"),
])
def test_adapters_take_reordered_latin_files(spark, tmp_path, name, text):
    path = put(tmp_path, f"{name}.csv", text, "latin-1")
    (quotes,) = files.load_sources(spark, [(name, path), ("mandi", str(tmp_path / "none.csv"))])
    assert [tuple(r)[:3] for r in quotes.collect()] == [(DAY, 9.0, "rïce")]
    assert set(quotes.columns) == set(schemas.QUOTE_COLUMNS) and name in adapters.ADAPTERS


def test_correlations_use_the_rows_a_pair_has(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 5.0, 7.0), (4.0, None, 1.0), (5.0, 4.0, 2.0), (None, 9.0, 3.0)]
    got = {(r.a, r.b): r.r for r in profile.corr_matrix(spark.createDataFrame(rows, "x double, y double, z double"), ["x", "y", "z"]).collect()}
    want = pd.DataFrame(rows, columns=["x", "y", "z"]).corr()
    assert all(got[a, b] == pytest.approx(want.loc[a, b]) for a in want for b in want)


def test_exponential_means_start_at_the_first_known_value(spark):
    values = [None, None, 100.0, 100.0, None, 90.0, *np.linspace(50, 400, 900).tolist(), None, 3.0]
    rows = [(DAY + dt.timedelta(days=i), v, None if i % 5 else float(i)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "date date, price double, other double")
    got = features.with_emas(df, [], {"a": ("price", 7), "b": ("price", 200), "c": ("other", 3), "d": ("price", 1)}).orderBy("date").toPandas()
    pdf = pd.DataFrame(rows, columns=["date", "price", "other"]).astype({"price": float, "other": float})
    for name, column, span in (("a", "price", 7), ("b", "price", 200), ("c", "other", 3), ("d", "price", 1)):
        want = pdf[column].ewm(span=span, adjust=False, ignore_na=True).mean()
        np.testing.assert_allclose(got[name].astype(float), want, rtol=1e-9)


def test_steps_cross_blocks_and_holes(spark):
    rows = [("m", i, float(v), float(p)) for i, v, p in ((0, 1, 1), (3, 2, 0), (4, 1, 2), (9, 5, 3), (10, 4, 1), (25, 9, 2), (26, 9, 2), (40, 1, 1))]
    df = spark.createDataFrame(rows, "model string, idx long, y_true double, y_pred double")
    got = {metrics.directional_accuracy(df, block_rows=b).first()["directional_acc"] for b in (1, 2, 3, 10, 1000)}
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    assert len(got) == 1 and got.pop() == pytest.approx(100 * (np.sign(np.diff(y)) == np.sign(np.diff(p))).mean())


def test_row_index_keeps_missing_dates_and_wide_or_clustered_ids(spark):
    ids = [-(2**63), 2**63 - 1, 0, *range(10, 90), 10**15, None]
    rows = [("s", DAY, i) for i in ids] + [("s", None, 3), ("s", None, 1), (None, DAY, 5), ("t", DAY, 7)]
    df = spark.createDataFrame(rows, "k string, date date, id long")
    for series, hot in (([], 10), (["k"], 10), (["k"], 10**6)):
        got = ordering.series_index(df, series, "date", "id", hot_rows=hot).collect()
        first = (lambda v, low: (v is not None, v if v is not None else low))
        want, count = [], {}
        for r in sorted(rows, key=lambda r: (first(r[1], DAY), first(r[2], 0))):
            group = r[0] if series else ""
            want.append((*r, count.get(group, 0)))
            count[group] = count.get(group, 0) + 1
        if series:
            assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        else:
            assert sorted(r["idx"] for r in got) == list(range(len(rows)))


def test_short_multiplicative_series_has_a_neutral_season(spark):
    rows = [(DAY + dt.timedelta(days=i), "a", 10.0 + i) for i in range(9)]
    df = spark.createDataFrame(rows, "date date, k string, price double")
    ahead = forecasters.holt_winters(df, ["k"], 3, seasonal="mul").orderBy("date").toPandas()["yhat"]
    np.testing.assert_allclose(ahead, [19, 20, 21], rtol=0.05)
