"""Driver entry point, model save/load, and micro-batch auditing of a stream."""

import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from pluvio.operators import models
from pluvio.plans.evaluate import Modelling, evaluate
from pluvio.plans.prepare import Preparation
from pluvio.streaming.monitor import audit_stream


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["metric", "value", "pct"]


def test_tree_save_load_and_evaluate(spark, obs_small):
    m = Modelling(Preparation(obs_small))
    tree = m.tree(maxDepth=5)
    path = tempfile.mkdtemp(prefix="pluvio-model-") + "/tree"
    models.save_model(tree, path)
    again = models.load_model(path, "tree")
    first = tree.transform(m.test).select("features", F.col("prediction").alias("p1"))
    both = again.transform(first)
    assert both.filter("p1 <> prediction").count() == 0
    table = {r.metric: r.value for r in evaluate(tree.transform(m.test)).collect()}
    assert 0 <= table["auc_roc"] <= 1 and abs(table["accuracy"] + table["error_rate"] - 1) < 1e-9
    assert table["ci_low"] <= table["error_rate"] <= table["ci_high"]


def test_stream_audit_matches_batch(spark, obs_small):
    src = tempfile.mkdtemp(prefix="pluvio-src-")
    obs_small.write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out, ck = tempfile.mkdtemp(prefix="pluvio-sink-"), tempfile.mkdtemp(prefix="pluvio-ck-")
    q = audit_stream(stream, out, ck)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out).filter("check = 'missing'").groupBy("column_name").agg(F.sum("n").alias("n"))
    from pluvio.operators.audit import missing_profile
    want = missing_profile(spark.read.parquet(src)).select("column_name", F.col("n_missing").alias("n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
