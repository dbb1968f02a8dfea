"""Files, adapters and cleaning on hand-made edge rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pricefield.functions.arithmetic import clip, div_inf, zero_if_not_finite
from pricefield.functions.text import date_from_parts, is_farm_product, lenient_date, strict_date
from pricefield.operators import cleaning, daily, panel, profile
from pricefield.session import shared_folder
from pricefield.sources import adapters, files, schemas


def test_tolerant_scan_keeps_short_and_drops_long_rows(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    got = files.read_csv_tolerant(spark, str(path), schemas.text_schema("a", "b", "c"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("1", "2", "3"), ("4", "5", None), ("10", "11", "12")], key=str)


def test_tolerant_scan_of_latin1_and_of_nothing(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes("a,b\ncaf\xe9,1\n".encode("latin-1"))
    schema = schemas.text_schema("a", "b")
    assert files.read_csv_tolerant(spark, str(path), schema).first()["a"] == "café"
    assert files.read_csv_tolerant(spark, str(tmp_path / "none.csv"), schema).count() == 0


def test_absent_sources_are_skipped(spark, tmp_path):
    path = tmp_path / "wfp.csv"
    path.write_text("date,price,commodity\n#date,#value,#item\n2020-01-05,3.5,Rice\nnever,1,Rice\n2020-01-06,x,Rice\n")
    schema = schemas.text_schema("date", "price", "commodity")
    got = files.load_sources(spark, [("wfp_india", str(path)), ("mandi", str(tmp_path / "no.csv"))])
    assert len(got) == 1
    assert [tuple(r) for r in got[0].collect()] == [(dt.date(2020, 1, 5), 3.5, "rice", "india_wfp")]


def test_csv_and_parquet_round_trip(spark, tmp_path):
    src = spark.createDataFrame([(dt.date(2020, 1, 1), 1.5, "rice", "s1"), (dt.date(2020, 1, 2), 2.5, "maize", "s2")], schemas.QUOTES)
    files.write_csv(src, str(tmp_path / "c"))
    assert sorted(files.read_csv(spark, str(tmp_path / "c"), schemas.QUOTES).collect()) == sorted(src.collect())
    files.write_parquet(src, str(tmp_path / "p"), ["source"])
    assert spark.read.parquet(str(tmp_path / "p")).where("source = 's2'").count() == 1


def test_json_results_scan_and_sink(spark, tmp_path):
    for name, r2 in (("lstm", 0.2), ("gru", 0.3)):
        (tmp_path / f"{name}_results.json").write_text(json.dumps({"model": name, "rmse": 1.0, "r2": r2, "params": 5}, indent=2))
    got = files.read_results(spark, str(tmp_path / "*_results.json"))
    assert {r["model"]: r["r2"] for r in got.collect()} == {"lstm": 0.2, "gru": 0.3}
    files.write_results(got, str(tmp_path / "out"))
    assert sorted(files.read_results(spark, str(tmp_path / "out")).collect()) == sorted(got.collect())
    files.write_results(got.coalesce(1), str(tmp_path / "one"))
    assert files.read_results(spark, str(tmp_path / "one")).count() == 2


def test_append_results_writes_elsewhere(spark, tmp_path):
    old = spark.createDataFrame([("a", 1.0, 0.2), ("b", 2.0, 0.4)], "model string, rmse double, r2 double")
    full = spark.createDataFrame([], schemas.RESULTS).unionByName(old, allowMissingColumns=True)
    files.write_csv(full, str(tmp_path / "v1"))
    new = spark.createDataFrame([("h", 0.5, 0.3)], "model string, rmse double, r2 double")
    out = files.append_results(spark, str(tmp_path / "v1"), new, str(tmp_path / "v2"))
    assert [r["model"] for r in out.collect()] == ["b", "h", "a"]
    with pytest.raises(ValueError):
        files.append_results(spark, str(tmp_path / "v1"), new, str(tmp_path / "v1"))


def test_header_and_resolver(spark):
    raw = spark.createDataFrame([(1, 2, 3)], [" Arrival Date ", "Min_x0020_Price", "Item"])
    names = schemas.rename_escaped(schemas.normalize_header(raw)).columns
    assert names == ["arrival_date", "min_price", "item"]
    assert schemas.find_column(names, "price") == "min_price"
    assert schemas.find_column(names, "volume") is None
    assert schemas.date_column(names) == "arrival_date"
    typed = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert schemas.numeric_features(typed, ["a"]) == ["b"]


def test_adapter_defaults(spark):
    raw = spark.createDataFrame([("2020-03-01", "4")], ["date", "average"])
    assert adapters.kalimati(raw).first()["commodity"] == "vegetable"
    with pytest.raises(ValueError):
        adapters.kalimati(raw.drop("average"))
    wide = spark.createDataFrame([("2020-03-01", "4", None, "7")], "Date string, GOLD string, SILVER string, OIL string")
    assert {r["commodity"] for r in adapters.wide_futures(wide).collect()} == {"gold", "oil"}
    assert {r["commodity"] for r in adapters.wide_futures(wide, commodities=["GOLD"], lower=False).collect()} == {"GOLD"}
    dated = spark.createDataFrame([("2020-03-01", "4", "Rice")], ["date", "price", "cm_name"])
    assert adapters.wfp_global(dated).first()["date"] == dt.date(2020, 3, 1)


def test_dates(spark):
    rows = spark.createDataFrame([("31-12-2020", "2020"), ("2020-12-31", "x"), (None, None)], ["d", "y"])
    assert [r[0] for r in rows.select(strict_date("d")).collect()] == [dt.date(2020, 12, 31), None, None]
    assert [r[0] for r in rows.select(lenient_date("d")).collect()] == [None, dt.date(2020, 12, 31), None]
    assert [r[0] for r in rows.select(date_from_parts("y", 2, 15)).collect()] == [dt.date(2020, 2, 15), None, None]


def test_category_words_hit_inside_other_words(spark):
    names = ["Watermelon", "Exchange rate", " Rice ", "Tomato concentrate", "Diesel", "Cashew"]
    rows = spark.createDataFrame([(n,) for n in names], ["commodity"])
    assert [r[0] for r in rows.where(is_farm_product("commodity")).collect()] == [" Rice ", "Cashew"]
    assert {r[0] for r in cleaning.excluded_categories(rows).collect()} == {
        "watermelon", "exchange rate", "tomato concentrate", "diesel"}


def test_arithmetic_edges(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in rows.select(div_inf("a", "b")).collect()]
    assert got == [float("inf"), float("-inf"), None, 1.5, None]
    assert [r[0] for r in rows.select(zero_if_not_finite(div_inf("a", "b"))).collect()] == [0, 0, 0, 1.5, 0]
    assert [r[0] for r in rows.select(clip("a", -0.5, 2)).collect()] == [1.0, -0.5, 0.0, 2.0, None]


def test_group_stats_of_single_and_flat_groups(spark):
    rows = spark.createDataFrame([("one", 1.0), ("flat", 2.0), ("flat", 2.0)], "k string, price_log double")
    got = {r["k"]: r["commodity_std"] for r in panel.group_stats(rows, "k").collect()}
    assert got == {"one": None, "flat": 1.0}
    z = panel.zscore(panel.join_group_stats(rows, "k")).select("price_normalized").distinct().collect()
    assert {r[0] for r in z} == {None, 0.0}


def test_one_hot_names_and_ties(spark):
    rows = spark.createDataFrame([("Rice (low) a-b",), ("x",), ("y",)], ["k"])
    got = cleaning.one_hot_topk(rows, "k", 2)
    assert got.columns == ["k", "is_Rice_low_a_b", "is_x"]


def test_missing_report_counts_nan(spark):
    rows = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (2.0, "c")], "x double, s string")
    got = [tuple(r) for r in profile.missing_report(rows).collect()]
    assert got == [("x", 2, 50.0), ("s", 1, 25.0)]


def test_histogram_of_equal_values(spark):
    rows = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    got = profile.histogram(rows, "x", 4).collect()
    assert [(r["bin"], r["left"], r["right"], r["n"]) for r in got] == [(2, 4.0, 4.25, 2)]


def test_shared_folder_follows_the_session():
    class Session:
        def __init__(self, master, folder=None):
            self.conf = {"spark.master": master} | ({"spark.checkpoint.dir": folder} if folder else {})

    assert shared_folder(Session("spark://cluster", "hdfs://shared/x")) == "hdfs://shared/x"
    own = shared_folder(Session("local[2]"))
    assert own and own == shared_folder(Session("local"))
    with pytest.raises(ValueError):
        shared_folder(Session("spark://cluster"))


def test_prices_that_are_missing_have_no_weight(spark):
    day = dt.date(2020, 1, 1)
    rows = spark.createDataFrame([("a", day, 10.0, 9.0), ("a", day, None, 99.0)], "k string, date date, price double, arrivals double")
    assert daily.daily_weighted(rows, ["k"]).first()["price"] == 10.0


def test_published_results_keep_their_versions(spark, tmp_path):
    folder = str(tmp_path / "results")

    def row(model, r2):
        return spark.createDataFrame([(model, r2)], "model string, r2 double")

    with pytest.raises(ValueError):
        files.read_published(spark, folder)
    assert files.append_published(spark, folder, row("a", 0.5)) == 1
    old = files.read_published(spark, folder)
    assert files.append_published(spark, folder, row("b", 0.9)) == 2
    assert [r["model"] for r in old.collect()] == ["a"]
    assert [r["model"] for r in files.read_published(spark, folder).orderBy(F.desc("r2")).collect()] == ["b", "a"]
    assert [r["model"] for r in files.read_published(spark, folder, 1).collect()] == ["a"]
    # A writer that read version 1 may not replace version 2.
    with pytest.raises(FileExistsError):
        files.publish_results(spark, folder, row("c", 0.1), 1)
    assert files.read_published(spark, folder).count() == 2
    # A writer that fails while it writes its rows leaves no version.
    broken = row("d", 0.1).withColumn("r2", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        files.publish_results(spark, folder, broken, 2)
    assert files.result_versions(spark, folder) == [1, 2]
