from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridia.functions import naming
from meridia.operators import encode, outliers, prep
from meridia.sources import readers, writers
from workload import views

HOUR = dt.datetime(2021, 3, 6)
COLUMNS = (
    "datetime_utc timestamp_ntz, country string, zone_name string, zone_id string, carbon_direct double, "
    "carbon_lifecycle double, cfe_percent double, re_percent double, data_source string, data_estimated boolean, "
    "data_estimation_method string, source_file string"
)


def _readings(spark):
    rows = [
        (HOUR + dt.timedelta(hours=h), "K", "Zone K", "XK", 100.0 + h, 120.0 + h, 10.0, None if h == 0 else 5.0,
         "b" if h < 2 else "a", h == 1, "M" if h == 1 else None, "hourly-2021.csv")
        for h in (0, 1, 2, 3, 26)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_rollup_of_a_day(spark):
    days = {r["date"]: r for r in prep.daily_rollup(_readings(spark)).collect()}
    day = days[dt.date(2021, 3, 6)]
    assert day["carbon_direct"] == 101.5 and day["re_percent"] == 5.0
    assert day["data_source"] == "a" and day["data_estimation_method"] == "M"
    assert (day["estimated_hour_flag"], day["hourly_row_count"], day["estimated_hour_share"]) == (1, 4, 0.25)
    assert day["datetime_utc"] == HOUR and day["data_estimated"] == 1
    assert days[dt.date(2021, 3, 7)]["data_estimation_method"] is None
    assert len(prep.daily_rollup(_readings(spark)).columns) == 16


def test_calendar_and_gaps(spark):
    row = prep.gap_features(prep.calendar_parts(prep.daily_rollup(_readings(spark)))).orderBy("date").first()
    assert (row["day"], row["month"], row["year"], row["hour"]) == (6, 3, 2021, 0)
    assert (row["day_of_week"], row["is_weekend"]) == (5, 1)
    assert row["carbon_intensity_gap"] == 20.0 and row["cfe_re_gap"] == 5.0


def test_clean_keeps_the_fullest_copy_and_rows_with_gaps(spark):
    rows = [("d1", 20, 50.0, 1.0, 2.0), ("d1", 24, 60.0, 1.0, 2.0), ("d2", 24, 130.0, 1.0, 2.0),
            ("d3", 24, None, 1.0, 2.0), ("d4", 24, 10.0, 3.0, 2.0), ("d5", 24, 10.0, -1.0, 2.0)]
    df = spark.createDataFrame(rows, "d string, n int, pct double, direct double, life double")
    got = prep.clean(df, ["d"], [F.col("n").desc()], {"pct": (0.0, 100.0), "direct": (0.0, None)}, [("life", "direct")])
    assert sorted((r["d"], r["n"]) for r in got.collect()) == [("d1", 24), ("d3", 24)]


def test_impute_and_null_profile(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (4.0, "y"), (10.0, None)], "v double, s string")
    profile = {r["column_name"]: r["null_count"] for r in prep.null_profile(df, ["v", "s"]).collect()}
    assert profile == {"v": 1, "s": 2}
    got = sorted((r["v"], r["s"]) for r in prep.impute(df, ["v"], ["s"]).collect())
    assert got == [(1.0, "x"), (4.0, "Unknown"), (4.0, "y"), (10.0, "Unknown")]


def test_all_null_measure_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert [r["v"] for r in prep.impute(df, ["v"]).collect()] == [None, None]
    assert [r["t"] for r in prep.quantile_class(df, "v", "t").collect()] == [None, None]


def test_quantile_class_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(7)], "v double")
    got = {r["v"]: r["t"] for r in prep.quantile_class(df, "v", "t").collect()}
    assert [got[float(v)] for v in range(7)] == ["Low"] * 3 + ["Medium"] * 2 + ["High"] * 2


def test_outlier_counts(spark):
    values = [float(v) for v in range(20)] + [500.0]
    df = spark.createDataFrame([(v, 1.0, None if v == 0 else v) for v in values], "a double, b double, c double")
    got = {r["a"]: r for r in outliers.zscore_outliers(outliers.iqr_outliers(df, ["a", "b", "c"]), ["a", "b", "c"]).collect()}
    assert got[500.0]["iqr_outlier_count"] == 2 and got[500.0]["zscore_outlier_count"] == 2
    assert got[3.0]["iqr_outlier_count"] == 0 and got[0.0]["iqr_outlier_count"] == 0
    both = outliers.outlier_consensus(df.select(F.lit(1).alias("x"), F.lit(0).alias("y")), ["x", "y"], 1).first()
    assert (both["outlier_consensus_count"], both["outlier_consensus_flag"]) == (1, 1)


def test_isolation_forest_finds_the_far_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    x[:8] += 9
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, a double, b double")
    one = outliers.isolation_forest(df.repartition(1), ["a", "b"], "id", contamination=0.02, trees=40)
    flagged = {r["id"] for r in one.where("isolation_forest_flag = 1").collect()}
    assert flagged == set(range(8))
    many = outliers.isolation_forest(df.repartition(7), ["a", "b"], "id", contamination=0.02, trees=40)
    assert {r["id"]: r["isolation_score"] for r in one.collect()} == pytest.approx(
        {r["id"]: r["isolation_score"] for r in many.collect()}
    )


def test_finished_columns(spark):
    assert len(prep.FEATURE_ORDER) == 19 and len(prep.NUMERIC_FEATURES) == 16 and len(prep.MONTHLY_COLUMNS) == 14
    shaped = prep.gap_features(prep.calendar_parts(prep.daily_rollup(_readings(spark))))
    final = prep.finalize(prep.quantile_class(shaped))
    assert final.columns == [*prep.FEATURE_ORDER, prep.TARGET]
    assert len(prep.monthly_aggregate(final).columns) == 31


def test_balance_stages(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "y string")
    after = before.unionByName(spark.createDataFrame([("b",)], "y string"))
    got = {(r["stage"], r["y"]): (r["row_count"], r["share"]) for r in prep.class_balance_compare(before, after, "y").collect()}
    assert got["after", "b"] == (2, 0.5) and got["before", "a"] == (2, pytest.approx(2 / 3))


def test_roles_labels_and_levels(spark):
    df = spark.createDataFrame([(1, True, "x", 2.0, "b"), (2, False, None, 3.0, "a")], "i int, f boolean, s string, d double, y string")
    assert encode.typed_columns(df, ["y"]) == (["i", "f", "d"], ["s"])
    with pytest.raises(ValueError, match="not found"):
        encode.split_features_and_target(df, "missing")
    assert [r["k"] for r in encode.label_encode(df, "y", "k").orderBy("i").collect()] == [1, 0]
    assert encode.levels(df, "y") == ["a", "b"]
    many = df.sparkSession.range(12_000).select(F.format_string("v%05d", "id").alias("y"), "id")
    assert encode.label_encode(many, "y", "k").where("k <> id").count() == 0
    hot = encode.one_hot(df, "s", ["w", "x"]).orderBy("i").collect()
    assert [(r["s_w"], r["s_x"]) for r in hot] == [(0, 1), (0, 0)]


def test_names_and_parameters(spark):
    df = spark.createDataFrame([("numeric__a__b", "SVM (Linear)", 0.00651, -0.5, {"b": "2", "a": "1"})],
                               "n string, m string, d double, e double, p map<string,string>")
    row = df.select(
        naming.clean_feature_name(F.col("n")), naming.slug(F.col("m")), naming.signed(F.col("d")),
        naming.signed(F.col("e")), naming.params_to_json(F.col("p")),
        naming.params_to_json(naming.without_param(F.col("p"), "a")),
    ).first()
    assert tuple(row) == ("a__b", "svm_linear", "+0.0065", "-0.5", '{"a":"1","b":"2"}', '{"b":"2"}')


def test_csv_files_are_tagged_and_checked(spark, tmp_path):
    header = ",".join(readers.HOURLY_COLUMNS)
    for year in (2021, 2022):
        line = f"{year}-01-01 00:00:00,K,Zone K,XK,1.0,2.0,3.0,4.0,src,true,"
        (tmp_path / f"hourly-{year}.csv").write_text(f"{header}\n{line}\n")
    rows = readers.read_hourly(spark, [str(tmp_path / f"hourly-{y}.csv") for y in (2021, 2022)]).orderBy("source_file").collect()
    assert [r["source_file"] for r in rows] == ["hourly-2021.csv", "hourly-2022.csv"]
    assert rows[0]["data_estimated"] is True and rows[0]["data_estimation_method"] is None
    with pytest.raises(FileNotFoundError, match="missing.csv"):
        readers.read_csv(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="target"):
        readers.read_csv(spark, str(tmp_path / "hourly-2021.csv"), required=["target"])
    inferred = readers.read_csv(spark, str(tmp_path / "hourly-2021.csv"))
    assert dict(inferred.dtypes)["Carbon intensity gCO₂eq/kWh (direct)"] == "double"


def test_csv_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "ab.csv").write_text("b,a\n1,2\n")
    columns = {"a": ("first", "int"), "b": ("second", "int")}
    assert tuple(readers.read_csv(spark, str(tmp_path / "ab.csv"), columns).drop("source_file").first()) == (2, 1)
    with pytest.raises(ValueError, match="absent"):
        readers.read_csv(spark, str(tmp_path / "ab.csv"), {"absent": ("x", "int")})
    (tmp_path / "bad.csv").write_text("b,a\n1,x\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), columns).collect()


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2,)], "id int")
    got = readers.union_tagged({"a": a, "b": b}).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "x", "a"), (2, None, "b")]


def test_sinks_read_back(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0]), "train"), (2, Vectors.dense([3.0, 4.0]), "test")], ["id", "features", "split"])
    writers.write_split(df, str(tmp_path), "raw")
    assert spark.read.parquet(f"{tmp_path}/raw").where("split = 'test'").first()["id"] == 2
    writers.write_split(df, str(tmp_path), "csv", fmt="csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").where("id = 1").first()["features"] == "[1.0,2.0]"
    lines = spark.createDataFrame([(2, "second"), (1, "first")], "line_no int, text string")
    writers.write_report(lines, f"{tmp_path}/report")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/report").collect()] == ["first", "second"]
    writers.write_table(df.select("id", "split"), f"{tmp_path}/table")
    assert spark.read.option("header", True).csv(f"{tmp_path}/table").count() == 2


def test_rows_that_break_the_contract_stand_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Share,Day\n1,0.5,2024-01-02\nx,2,never\n3,,\n4,7,2024-01-03\n5\n6,1,2024-01-04,more\n")
    (tmp_path / "b.csv").write_text("Id,Share,Day\n,1,2024-01-05\n8,0,2024-01-06\n")
    columns = {"Day": ("day", "date"), "Id": ("id", "long"), "Share": ("share", "double")}
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    good, rejected = readers.read_csv_apart(spark, paths, columns, {"share": (0.0, 1.0)}, ["id"])
    assert good.columns == ["day", "id", "share", "source_file"]
    assert sorted((r.id, r.share, str(r.day)) for r in good.collect()) == [(1, 0.5, "2024-01-02"), (3, None, "None"), (8, 0.0, "2024-01-06")]
    got = {(r.source_file, r.line): r.reasons for r in rejected.collect()}
    assert got == {
        ("a.csv", "x,2,never"): ["day:type", "id:type", "share:range"],
        ("a.csv", "4,7,2024-01-03"): ["share:range"],
        ("a.csv", "5"): ["fields"],
        ("a.csv", "6,1,2024-01-04,more"): ["fields"],
        ("b.csv", ",1,2024-01-05"): ["id:null"],
    }
    with pytest.raises(ValueError):
        readers.read_csv_apart(spark, paths, {"absent": ("x", "int")})


def test_empty_files_give_two_empty_tables(spark, tmp_path):
    (tmp_path / "none.csv").write_text("Id\n")
    good, rejected = readers.read_csv_apart(spark, str(tmp_path / "none.csv"), {"Id": ("id", "long")})
    assert good.count() == rejected.count() == 0


def test_labeled_days_read_the_readings_once(spark, tmp_path):
    start = dt.datetime(2021, 1, 1)
    lines = [
        (i, i % 7, 100 * (i % 3), i % 4, 1.0, 10.0 + i * i % 17, 0.1, 0.02, "ANR"[i % 3], "OF"[i % 2], start + dt.timedelta(days=i % 5))
        for i in range(60)
    ]
    kind = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    days = views.labeled(spark, str(tmp_path))
    assert not [f for f in days.inputFiles() if "lineitem" in f]
    plain = prep.quantile_class(views.daily(spark, str(tmp_path)))
    assert sorted(map(str, days.collect())) == sorted(map(str, plain.collect()))
