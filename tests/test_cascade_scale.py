"""The cascade's steps that decide its cost: medians of sorted groups, statistics sent to the rows, folds without Python, shared trees."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from pluvio.functions.columns import calendar_keys
from pluvio.operators import joins, models
from pluvio.operators.groupstats import group_stats
from pluvio.operators.quantiles import sorted_medians
from pluvio.session import compilable


@pytest.fixture
def grouped(spark):
    r = np.random.default_rng(5)
    rows = [(None if g == 3 else f"k{g}", int(g % 2), None if r.random() < .2 else float(r.integers(0, 50)),
             float("nan") if r.random() < .2 else float(r.normal()), None) for g in range(40) for _ in range(1 + 30 * (g % 7))]
    return spark.createDataFrame(rows, "a string, b int, x double, y double, z double").repartition(5)


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_sorted_medians_across_batches(spark, grouped, batch):
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = _rows(sorted_medians(grouped, ["a", "b"], ["x", "y", "z"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    own = {}
    for a, b, *values in grouped.collect():
        own.setdefault((a, b), []).append(values)
    median = lambda v: v[(len(v) - 1) // 2] if v else None
    want = [(a, b, *(median(sorted(x for x in c if x is not None and x == x)) for c in zip(*v))) for (a, b), v in own.items()]
    assert found == sorted(map(str, want))


def test_medians_ways_agree(grouped):
    ways = [_rows(group_stats(grouped, ["a", "b"], ["x"], ["x", "y", "z"], medians=m)) for m in ("exact", "sorted", "measured", "exact_spread")]
    assert all(w == ways[0] for w in ways)


def test_measured_medians_keep_no_table_of_values(grouped):
    plan = group_stats(grouped, ["a", "b"], median_cols=["x"], medians="measured")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "percentile" not in plan.lower()


def test_statistics_reach_the_rows_without_a_shuffle_of_rows(spark, grouped, monkeypatch):
    stats = grouped.groupBy("a", "b").agg(F.count("x").alias("n"))
    sent = joins.join_statistics(grouped, [stats], ["a", "b"])
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    by_shuffle = joins.join_statistics(grouped, [stats], ["a", "b"])
    assert _rows(sent) == _rows(by_shuffle) == _rows(joins.left_join(grouped, [stats], ["a", "b"]))
    assert any(r["n"] is None for r in sent.collect())  # a null key matches nothing


def test_day_month_as_formatted(spark):
    days = spark.sql("select explode(sequence(date'0999-12-28', date'1001-01-05')) as Date union all select date'2024-02-29' union all select null")
    wrong = calendar_keys(days).filter(~F.col("DayMonth").eqNullSafe(F.date_format("Date", "ddMM")))
    assert wrong.count() == 0


def test_methods_are_split_for_the_compiler(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        compilable(spark)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "3000")
        compilable(spark)
        assert spark.conf.get(name) == "3000"
    finally:
        spark.conf.set(name, was)


@pytest.fixture
def folded(spark):
    r = np.random.default_rng(3)
    x = r.integers(0, 12, (3000, 4)).astype(float)
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 5) + r.normal(0, 4, 3000) > 12).astype(float)
    rows = [(*map(float, a), float(b), i % 2) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double, fold int")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).coalesce(2).cache()


GRID = {"impurity": ["gini", "entropy"], "maxDepth": [0, 2, 6]}


def test_shared_depths_equal_plain_cross_validation(folded, monkeypatch):
    fits = []
    fit = DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: (fits.append(1), fit(self, df))[1])
    found = models.cross_validate(folded, DecisionTreeClassifier(), GRID, k=2, fold_col="fold")
    assert len(fits) == 2 * 2 + 1  # one a fold and impurity, and the best
    est = DecisionTreeClassifier()
    plain = CrossValidator(estimator=est, estimatorParamMaps=models.param_grid(est, GRID),
                           evaluator=BinaryClassificationEvaluator(), numFolds=2, foldCol="fold", seed=2025).fit(folded)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    assert found.stdMetrics == pytest.approx(plain.stdMetrics, abs=1e-12)
    assert found.bestModel.toDebugString.split("\n")[1:] == plain.bestModel.toDebugString.split("\n")[1:]
    assert [r["params"] for r in models.cv_table(folded.sparkSession, found).collect()] == [r["params"] for r in models.cv_table(folded.sparkSession, plain).collect()]


def test_folds_are_plain_filters(folded):
    cv = models._FoldValidator(numFolds=2).setFoldCol("fold")
    for training, validation in cv._kFold(folded):
        assert training.count() + validation.count() == 3000
        assert "Python" not in training._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        models._folds(folded.withColumn("fold", F.col("fold") + 1), "fold", 2)
