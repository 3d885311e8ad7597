"""Golden cases for the daily-series and circular operators."""

import datetime as dt

from pluvio.config import Roles
from pluvio.operators import series, transforms

SPEC = Roles(normal=("t",), non_normal=(), discrete=(), directions=("w",))


def d(day):
    return dt.date(2024, 1, day)


def test_neighbour_mean_or_single_side(spark):
    rows = [("A", d(1), 1.0), ("A", d(2), None), ("A", d(3), 3.0), ("A", d(4), None),
            ("B", d(1), None), ("B", d(2), 5.0)]
    df = spark.createDataFrame(rows, "Location string, Date date, t double")
    daily = series.daily_series(df, ["t"], SPEC)
    got = {(r.Location, r.Date.day): r.t for r in series.neighbour_impute(daily, ["t"], SPEC).collect()}
    assert got[("A", 2)] == 2.0      # mean of both neighbours
    assert got[("A", 4)] == 3.0      # only the previous day exists
    assert got[("B", 1)] == 5.0      # only the next day exists


def test_circular_fill_and_cancellation(spark):
    rows = [("A", d(1), "E"), ("A", d(2), None), ("A", d(3), "N"),
            ("B", d(1), "E"), ("B", d(2), None), ("B", d(3), "W")]
    df = spark.createDataFrame(rows, "Location string, Date date, w string")
    got = {(r.Location, r.Date.day): r.w for r in series.circular_impute(df, ["w"], SPEC).collect()}
    assert got[("A", 2)] == "NE"     # E + N → 45°
    assert got[("B", 2)] is None     # E + W cancel
    filled = series.circular_month_fallback(series.circular_impute(df, ["w"], SPEC), df, ["w"], SPEC)
    # January's mean of E, N, E, W is the direction of E + N → NE.
    assert {(r.Location, r.Date.day): r.w for r in filled.collect()}[("B", 2)] == "NE"


def test_bins_and_standardisation(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 11)], "x double")
    splits = transforms.quantile_splits(df, ["x"], n=5)
    assert splits == {"x": [2.0, 4.0, 6.0, 8.0]}
    bins = [r.x_bin for r in transforms.quantile_bins(df, splits).orderBy("x").collect()]
    assert bins == [0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 4.0, 4.0]
    stats = transforms.scaler_stats(df, ["x"])
    z = [r.x_std for r in transforms.standardize(df, stats).orderBy("x").collect()]
    assert abs(sum(z)) < 1e-9 and abs(z[-1] - 1.486301231) < 1e-6
