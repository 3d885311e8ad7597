"""Full-precision fills, column guard, date totals, token-free categories, retention while stages are written."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from pluvio.config import WEATHER
from pluvio.functions.predicates import complete_rows
from pluvio.operators import audit, explore, impute, series
from pluvio.operators.transforms import Passage, retention
from pluvio.plans.prepare import normalize

SPEC = WEATHER.with_(normal=("x",), non_normal=(), discrete=())


def test_tiny_means_fill_in_full(spark):
    df = spark.createDataFrame([("a", 1e-11), ("a", 3e-11), ("a", None)], "k string, x double")
    got = sorted(r["x"] for r in impute.impute_by(df, df, ["k"], SPEC).collect())
    assert got == [1e-11, pytest.approx(2e-11, rel=1e-12), 3e-11]
    rounded = sorted(r["x"] for r in impute.impute_by(df, df, ["k"], SPEC.with_(mean_decimals=9)).collect())
    assert rounded == [0.0, 1e-11, 3e-11]


def test_tiny_daily_means_and_rates_in_full(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", day, 1e-11), ("a", day, 3e-11)], "Location string, Date date, x double")
    assert series.daily_series(df, ["x"], SPEC).first()["x"] == pytest.approx(2e-11, rel=1e-12)
    labels = spark.createDataFrame([("Yes",)] + [("No",)] * 2, "RainTomorrow string")
    assert explore.majority_baseline(labels).first()["accuracy"] == 2 / 3


def test_absent_columns_are_named(spark, obs_small):
    with pytest.raises(ValueError, match="Sunshine, Cloud9am"):
        normalize(obs_small.drop("Sunshine", "Cloud9am"))


def test_mean_and_median_of_each_column(spark):
    rows = [("a", 1.0, 1), ("a", 2.0, 2), ("a", 9.0, 2), ("b", None, None)]
    spec = WEATHER.with_(normal=("x",), non_normal=("c",), discrete=("c",))
    got = impute.wide_stats(spark.createDataFrame(rows, "k string, x double, c int"), ["k"], spec).collect()
    assert [r.asDict() for r in got] == [{"k": "a", "x_mean": 4.0, "x_median": 2.0, "c_mean": 5 / 3}]


def test_bad_dates_with_their_total(spark):
    rows = [("x", "a")] * 30 + [("y", None)] * 2 + [("2024-01-01", "a"), (None, "a")]
    got = audit.invalid_date_report(spark.createDataFrame(rows, "Date string, Location string")).collect()
    assert [tuple(r) for r in got] == [("y", None, 32)] * 2 + [("x", "a", 32)] * 18
    clean = spark.createDataFrame([("2024-01-01", "a")], "Date string, Location string")
    assert audit.invalid_date_report(clean).collect() == []


def test_token_free_categories(spark):
    df = spark.createDataFrame([("N",), ("N",), (" na ",), (None,), ("S",)], "WindGustDir string")
    assert {(r["value"], r["n"]) for r in explore.top_k(df, ["WindGustDir"], drop_missing=True).collect()} == {("N", 2), ("S", 1)}
    assert {r["value"] for r in explore.top_k(df, ["WindGustDir"]).collect()} == {"N", " na ", "S"}
    assert {r["value"] for r in explore.rare_categories(df, ["WindGustDir"], 2, drop_missing=True).collect()} == {"S"}
    assert {r["value"] for r in explore.rare_categories(df, ["WindGustDir"], 2).collect()} == {None, " na ", "S"}


def test_profile_preview_and_complete_rows(spark):
    df = spark.range(9).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, "a").otherwise(" N/A ").alias("t"))
    assert [(r["column_name"], r["nullable"], r["n_rows"]) for r in audit.table_profile(df).collect()] == [("n", False, 9), ("t", False, 9)]
    assert [r["n"] for r in audit.preview(df, 3, [F.desc("n")]).collect()] == [8, 7, 6]
    assert audit.preview(df).count() == 5
    assert [r["n"] for r in complete_rows(df, ["n", "t"]).collect()] == [0, 2, 4, 6, 8]


def test_passage_counts_what_it_writes(spark):
    stages = [("all", spark.range(1000).repartition(7)), ("third", spark.range(0, 1000, 3)), ("none", spark.range(5).filter("id > 9"))]
    seen = Passage()
    stored = [seen.write(name, df) for name, df in stages]
    assert [df.count() for df in stored] == [1000, 334, 0]
    assert [tuple(r) for r in seen.table(spark).collect()] == [tuple(r) for r in retention(stages).collect()]
    empty = Passage()
    empty.write("none", spark.range(0))
    empty.write("next", spark.range(0))
    assert [tuple(r) for r in empty.table(spark).collect()] == [("none", 0, 0, None), ("next", 0, 0, None)]


def test_passage_reads_no_stage_again(spark, tmp_path):
    """The input's files may go once the stage is written: its count needs no other scan."""
    spark.range(100).write.parquet(f"{tmp_path}/in")
    seen = Passage()
    seen.write("in", spark.read.parquet(f"{tmp_path}/in"))
    for file in glob.glob(f"{tmp_path}/in/*.parquet"):
        open(file, "wb").close()
    assert seen.table(spark).first()["n_rows"] == 100
