"""Results that depend neither on size nor on scale of the values; NaN is a missing value."""

import math

import pytest
from pyspark.sql import functions as F

from pluvio.operators.correlation import corr_with_label
from pluvio.operators.explore import numeric_summary
from pluvio.operators.groupstats import group_stats
from pluvio.operators.transforms import model_sets
from pluvio.sources.tables import read_table, write_table
from pluvio.streaming import monitor


def test_small_values_keep_their_precision(spark):
    df = spark.createDataFrame([(1e-11,), (3e-11,), (math.nan,), (None,)], "Rainfall double")
    row = numeric_summary(df, ["Rainfall"]).first()
    assert row["mean"] == pytest.approx(2e-11, rel=1e-12) and row["max"] == 3e-11
    assert row["stddev"] == pytest.approx(math.sqrt(2) * 1e-11, rel=1e-9)


def test_median_of_a_group_of_three_million_different_values(spark):
    n = 3_000_001
    big = spark.range(n).select(F.lit("a").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("x"))
    for way in ("exact", "exact_spread"):
        row = group_stats(big, ["k"], median_cols=["x"], medians=way).first()
        assert row["x_median"] == (n - 1) / 2


def test_median_of_few_groups_is_spread(spark, obs_small, monkeypatch):
    from statistics import median_low

    from pluvio.operators import quantiles, series
    from pluvio.plans.prepare import normalize

    monkeypatch.setattr(quantiles, "PER_RANGE", 100)
    rows = [(k, float(i * 7919 % 1009)) for i, k in enumerate(["a", "b", None, "a"] * 250)] + [("b", 5.0)] * 900
    got = {r["k"]: (r["x_mean"], r["x_median"]) for r in group_stats(
        spark.createDataFrame(rows, "k string, x double"), ["k"], ["x"], ["x"]).collect()}
    assert {k: m for k, (_, m) in got.items()} == {k: median_low([x for j, x in rows if j == k]) for k in ("a", "b", None)}
    norm = normalize(obs_small)
    plan = series.impute_month(norm, norm)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in plan


def test_nan_is_missing_in_group_statistics(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", 5.0), ("a", math.nan), ("b", math.nan)]
    got = {r["k"]: (r["x_mean"], r["x_median"]) for r in group_stats(
        spark.createDataFrame(rows, "k string, x double"), ["k"], ["x"], ["x"]).collect()}
    assert got == {"a": (3.0, 3.0)}
    with pytest.raises(ValueError):
        group_stats(spark.createDataFrame(rows, "k string, x double"), ["k"], medians="other")


def test_nan_drops_the_row_not_the_feature(spark):
    rows = [(float(i), "Yes" if i % 3 else "No") for i in range(20)]
    clean = corr_with_label(spark.createDataFrame(rows, "Rainfall double, RainTomorrow string"), ["Rainfall"]).first()
    dirty = corr_with_label(spark.createDataFrame(rows + [(math.nan, "Yes")], "Rainfall double, RainTomorrow string"), ["Rainfall"]).first()
    assert dirty["r"] == pytest.approx(clean["r"], rel=1e-12)


def test_model_sets_with_a_column_without_values(spark):
    df = spark.createDataFrame([(float(i), None, 1 + i % 12, 0.0) for i in range(30)], "a double, b double, Month int, label double")
    train, test = model_sets(df, df, ["a", "b"])
    row = train.first()
    assert len(row["features_linear"]) == 4 and len(row["features_binned"]) == 2
    assert test.count() == 30


def test_replayed_batch_replaces_its_audit(spark, obs_small, tmp_path, monkeypatch):
    captured = {}

    class Writer:
        def foreachBatch(self, f):
            captured["write"] = f
            return self

        def option(self, *_):
            return self

        def start(self):
            return None

    class Stream:
        writeStream = Writer()

    monitor.audit_stream(Stream(), str(tmp_path / "out"), str(tmp_path / "ck"))
    for _ in range(2):
        captured["write"](obs_small.limit(50), 7)
    got = spark.read.parquet(str(tmp_path / "out"))
    once = monitor.audit_batch(obs_small.limit(50), 7).count()
    assert got.count() == once and got.select("batch_id").distinct().collect()[0][0] == 7


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a, \"b\"", None), (2, None, 2.5)], "i int, s string, x double")
    for fmt in ("csv", "parquet"):
        path = write_table(df, str(tmp_path / fmt), fmt)
        assert sorted(map(tuple, read_table(spark, path, fmt, schema=df.schema).collect())) == sorted(map(tuple, df.collect()))
    assert dict(read_table(spark, str(tmp_path / "csv"), "csv").dtypes)["i"] == "int"
    with pytest.raises(ValueError):
        read_table(spark, "x", "orc")


def test_correlation_of_offset_and_merged_columns_equals_numpy(spark):
    import numpy as np
    from pluvio.operators.correlation import Moments, corr_matrix
    rng = np.random.default_rng(6)
    base = rng.normal(size=(5000, 3))
    data = np.column_stack([base[:, 0] + 1e9, base[:, 0] * 0.5 + base[:, 1] - 1e9, base[:, 2] * 1e-6 + 3, np.full(5000, 0.1)])
    frame = spark.createDataFrame([("Yes" if i % 2 else "No", *map(float, r)) for i, r in enumerate(data)], "RainTomorrow string, a double, b double, c double, k double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr_matrix(frame.repartition(9), ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef((data[:, :3] - data[0, :3]).T)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        assert abs(got["abc"[i], "abc"[j]] - want[i, j]) < 1e-9
    assert [got[x, "k"] for x in "abc"] == [None] * 3
    one, two, both = (Moments.of(data[s]) for s in (slice(0, 7), slice(7, None), slice(None)))
    merged = one.merge(two)
    assert merged.n == both.n and np.allclose(merged.mean, both.mean, rtol=1e-15) and np.allclose(merged.products, both.products, rtol=1e-7, atol=1e-9)
    assert corr_matrix(frame.filter("false"), ["a", "b"]).count() == 0
