"""Operators whose plans must not multiply rows, against brute force on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import audit, correlation, explore, metrics
from pluvio.sources.obs import obs

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_corr_matrix_equals_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 1e-6, 1e6] + [0, 5, 1e7]
    x[:, 2] += 1e6 * x[:, 0]
    rows = [(*map(float, r), "Yes") for r in x] + [(math.nan, 1.0, 1.0, "Yes"), (None, 1.0, 1.0, "No"), (9.0, 9.0, 9.0, "NA")]
    df = spark.createDataFrame(rows, "a double, b double, c double, RainTomorrow string")
    want = np.corrcoef(x.T)
    for r in correlation.corr_matrix(df, ["a", "b", "c"]).collect():
        assert r["r"] == pytest.approx(want["abc".index(r["col_a"]), "abc".index(r["col_b"])], abs=1e-9)


def test_corr_matrix_of_few_or_constant_rows(spark):
    kind = "a double, b double, RainTomorrow string"
    assert correlation.corr_matrix(spark.createDataFrame([], kind), ["a", "b"]).collect() == []
    for rows in ([(1.0, 2.0, "Yes")], [(1.0, 2.0, "Yes"), (1.0, 3.0, "No")]):
        assert [tuple(r) for r in correlation.corr_matrix(spark.createDataFrame(rows, kind), ["a", "b"]).collect()] == [("a", "b", None)]


def test_cooccurrence_of_many_columns(spark):
    cols = [f"c{i:02d}" for i in range(70)]
    rows = [tuple(None if (r * (i + 3)) % 7 < i % 5 else "x" for i in range(70)) for r in range(40)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    lost = {c: [r[i] is None for r in rows] for i, c in enumerate(cols)}
    worst = sorted(cols, key=lambda c: (-sum(lost[c]), c))[:4]
    want = {(a, b): sum(x and y for x, y in zip(lost[a], lost[b])) for n, a in enumerate(worst) for b in worst[n + 1:]}
    got = audit.missing_cooccurrence(df, 4, cols)
    assert {(r["col_a"], r["col_b"]): r["n_both"] for r in got.collect()} == want


def test_summary_over_several_chunks(spark):
    cols = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(float(r * i) for i in range(20)) for r in range(3)], ", ".join(f"{c} double" for c in cols))
    got = {r["column_name"]: r["mean"] for r in explore.numeric_summary(df, cols).collect()}
    assert got == {f"c{i}": float(i) for i in range(20)}


def test_rows_are_not_multiplied(spark):
    frame = obs(spark, SF)
    for df in (explore.numeric_summary(frame), audit.missing_cooccurrence(frame)):
        plan = plan_of(df)
        source = plan_of(frame)
        # one Generate is the source's own; the others stand above the aggregate, on its single row
        last = plan.rindex("HashAggregate") if "HashAggregate" in plan else plan.rindex("SortAggregate")
        assert plan[last:].count("Generate") + plan[last:].count("Expand") <= source.count("Generate") + source.count("Expand")


def test_confusion_counts_pairs_outside_the_labels(spark):
    pred = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 2.0), (0.0, 2.0), (None, 1.0)], "label double, prediction double")
    got = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion(pred).collect()}
    assert got == {(0.0, 0.0): 1, (0.0, 1.0): 0, (1.0, 0.0): 1, (1.0, 1.0): 0, (None, None): 2}
    row = metrics.error_rate(pred).first()
    assert (row["n"], row["accuracy"]) == (4, 0.5)
    rates = {r["label"]: r for r in metrics.rates_by_label(pred).collect()}
    assert rates[0.0]["n"] == 2 and rates[0.0]["tpr"] == 0.5 and rates[0.0]["fpr"] == 0.5
