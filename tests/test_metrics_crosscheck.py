"""Window/prefix-sum metrics against Spark ML's evaluators on the same frame."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from pluvio.operators import metrics


def scored(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    label = F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0)
    s = li.select(label.alias("label"), (F.col("l_quantity") / 50 + 0.2 * label).alias("score"))
    return s.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


def test_auc_matches_evaluator_without_bins(spark):
    df = scored(spark).coalesce(1)
    for metric, fn in (("areaUnderROC", metrics.auc_roc), ("areaUnderPR", metrics.auc_pr)):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0).evaluate(df)
        ours = fn(df, "score").first()[0]
        assert abs(ev - ours) < 1e-8, metric


def test_binned_auc_matches_single_partition_evaluator(spark):
    df = scored(spark).coalesce(1)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=17).evaluate(df)
    assert abs(ev - metrics.auc_roc(df, "score", bins=17).first()[0]) < 1e-8


def test_rates_match_multiclass_evaluator(spark):
    df = scored(spark)
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    w = metrics.weighted_rates(df).first()
    assert abs(w.weighted_tpr - ev.setMetricName("weightedTruePositiveRate").evaluate(df)) < 1e-8
    assert abs(w.weighted_fpr - ev.setMetricName("weightedFalsePositiveRate").evaluate(df)) < 1e-8
    assert abs(w.weighted_f1 - ev.setMetricName("f1").evaluate(df)) < 1e-8
    e = metrics.error_rate(df).first()
    assert abs(e.accuracy - ev.setMetricName("accuracy").evaluate(df)) < 1e-8
    for r in metrics.rates_by_label(df).collect():
        ev.setMetricLabel(r.label)
        assert abs(r.tpr - ev.setMetricName("truePositiveRateByLabel").evaluate(df)) < 1e-8
        assert abs(r.fpr - ev.setMetricName("falsePositiveRateByLabel").evaluate(df)) < 1e-8


def test_curves_of_ten_million_scores(spark):
    """100 ranges; the areas have closed forms, and the source is read once."""
    from pluvio.operators import metrics
    n = 10_000_000
    pred = spark.range(n, numPartitions=8).selectExpr(f"id / {n}D as score", "double(id % 2) as label")
    area = metrics.auc_roc(pred).first()["auc_roc"]
    # of all pairs of a positive and a negative the positive has the higher score in (m + 1) / 2m of them, m = n / 2
    assert abs(area - (n / 2 + 1) / n) < 1e-9


def test_prefix_sums_over_many_ranges_with_nulls_and_nan(spark, monkeypatch):
    from pluvio.operators import metrics
    monkeypatch.setattr(metrics, "PER_RANGE", 7)
    rows = [(float(i % 50), i) for i in range(50)] + [(float("nan"), 1000), (None, 5000), (-0.5, 3)]
    df = spark.createDataFrame(rows, "s double, v long")
    got = {str(r["s"]): (r["cum_v"], r["tot_v"]) for r in metrics.descending_prefix(df, "s", ["v"]).collect()}
    total = sum(v for _, v in rows)
    assert got["nan"] == (1000, total) and got["None"] == (total, total) and got["-0.5"] == (total - 5000, total)
    assert got["10.0"][0] == 1000 + sum(range(10, 50))
    assert metrics.descending_prefix(df.filter("false"), "s", ["v"]).count() == 0
