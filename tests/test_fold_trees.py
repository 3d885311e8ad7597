"""Trees and forests grown for all folds and settings at once against Spark's own fits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from pluvio.operators import fold_trees, models


def _table(spark, tmp_path, n):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 5))
    x[:, 0], x[:, 1], x[:, 4] = np.round(x[:, 0] * 3), np.round(x[:, 1], 1), np.abs(np.round(x[:, 4] * 2))
    label = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 2 > 0.5).astype(float)
    rows = spark.createDataFrame(pd.DataFrame(dict(x=list(x), label=label, fold=rng.integers(0, 2, n).astype("int32"))))
    rows.select(array_to_vector("x").alias("features"), "label", "fold").repartition(3).write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def _plain(df, est, grid):
    return CrossValidator(estimator=est, estimatorParamMaps=models.param_grid(est, grid), evaluator=BinaryClassificationEvaluator(),
                          numFolds=2, foldCol="fold", seed=2025, parallelism=2).fit(df)


def _fits(monkeypatch, kind):
    fits, fit = [], kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, df: (fits.append(1), fit(self, df))[1])
    return fits


def test_forests_equal_plain_cross_validation(spark, tmp_path, monkeypatch):
    df, grid = _table(spark, tmp_path, 3000), {"maxBins": [12, 20], "maxDepth": [2, 6]}
    fits = _fits(monkeypatch, RandomForestClassifier)
    found = models.cross_validate(df, models.forest(seed=2025), grid, k=2, fold_col="fold")
    assert len(fits) <= 1  # no fit per fold and setting
    plain = _plain(df, models.forest(seed=2025), grid)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    assert found.stdMetrics == pytest.approx(plain.stdMetrics, abs=1e-12)
    assert found.bestModel.toDebugString.split("\n")[1:] == plain.bestModel.toDebugString.split("\n")[1:]


def test_a_level_may_take_many_passes(spark, tmp_path, monkeypatch):
    df, grid, passes, splits = _table(spark, tmp_path, 400), {"maxDepth": [2]}, [], fold_trees._splits
    monkeypatch.setattr(fold_trees, "HELD", 1)
    monkeypatch.setattr(fold_trees, "_splits", lambda *own: (passes.append(1), splits(*own))[1])
    found = models.cross_validate(df, models.forest(seed=7, numTrees=2, maxBins=8), grid, k=2, fold_col="fold")
    assert len(passes) > 4
    assert found.avgMetrics == pytest.approx(_plain(df, models.forest(seed=7, numTrees=2, maxBins=8), grid).avgMetrics, abs=1e-12)


def test_missing_features_fail_as_in_a_fit(spark, tmp_path):
    df = _table(spark, tmp_path, 400)
    holes = df.withColumn("features", array_to_vector(F.array(*[F.when(F.rand(3) < 0.01, float("nan")).otherwise(F.rand(c)) for c in range(5)])))
    with pytest.raises(Exception, match="(?i)nan"):
        models.cross_validate(holes, models.forest(seed=7), {"maxDepth": [2]}, k=2, fold_col="fold")


def test_trees_of_sampled_rows_equal_plain_cross_validation(spark, tmp_path, monkeypatch):
    df, grid = _table(spark, tmp_path, 60_000), {"impurity": ["gini", "entropy"], "maxDepth": [3, 5]}  # cuts from a third of the rows
    monkeypatch.setattr(models, "MANY_ROWS", 0)
    fits = _fits(monkeypatch, DecisionTreeClassifier)
    found = models.cross_validate(df, DecisionTreeClassifier(seed=11), grid, k=2, fold_col="fold")
    assert len(fits) == 1  # the best; none per fold and setting
    plain = _plain(df, DecisionTreeClassifier(seed=11), grid)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    assert found.stdMetrics == pytest.approx(plain.stdMetrics, abs=1e-12)


def test_a_large_sample_has_more_cuts_than_bins_ask_for():
    assert len(fold_trees._cuts(np.arange(1.0, 1001.0), 880.0, 10)) == 11  # a cut every 88 values, as in Spark
    assert len(fold_trees._cuts(np.arange(1.0, 1001.0), 1000.0, 10)) == 9


def test_rows_without_a_vector_are_left_to_spark(spark, tmp_path, monkeypatch):
    df = _table(spark, tmp_path, 400)
    monkeypatch.setattr(fold_trees.FoldTrees, "grow", lambda self: pytest.fail("grown without their vectors"))
    monkeypatch.setattr(models, "MANY_ROWS", 0)
    with pytest.raises(Exception, match="(?i)null"):
        models.cross_validate(df.withColumn("features", F.when(F.rand(3) < 0.9, F.col("features"))), models.forest(seed=7), {"maxDepth": [2]}, k=2, fold_col="fold")
