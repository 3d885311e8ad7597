"""Joins with null and hot keys, the exact split, histogram trees and models as tables."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pluvio.operators import histogram, model_table, models
from pluvio.operators.joins import left_join, measured_broadcast, semi_join_top
from pluvio.operators.split import exact_stratified


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(7)
    rows = [(None if rng.random() < 0.9 else "hot" if rng.random() < 0.7 else rng.choice("abc"), rng.choice([1, 2, None]), i) for i in range(20_000)]
    return spark.createDataFrame(rows, "k string, m int, i int").cache()


@pytest.mark.parametrize("hot_rows", [50, 10**9])
def test_left_join_equals_the_plain_one(keyed, hot_rows):
    first = keyed.groupBy("k", "m").agg(F.count("*").alias("n"))
    second = keyed.filter("k <> 'a'").groupBy("k", "m").agg(F.max("i").alias("most"))
    want = keyed.join(first, ["k", "m"], "left").join(second, ["k", "m"], "left").select("k", "m", "i", "n", "most")
    assert bag(left_join(keyed, [first, second], ["k", "m"], hot_rows, salts=5).select("k", "m", "i", "n", "most")) == bag(want)
    empty = keyed.filter("false")
    assert left_join(empty, [first], ["k", "m"], hot_rows).count() == 0
    assert bag(left_join(keyed, [first.limit(0)], ["k", "m"], hot_rows).select("n").distinct()) == Counter([(None,)])


def test_no_task_of_the_join_gathers_null_or_hot_keys(spark, keyed):
    stats = keyed.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join(keyed.select("k", "i"), [stats], ["k"], hot_rows=200, salts=64)
        sizes = sorted(r["count"] for r in joined.filter("k is not null").groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # by key, 'hot' alone would have seven tenths of the rows in one of eight parts
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2] and sizes[-1] < 0.3 * sum(sizes)


def test_semi_join_top(keyed, monkeypatch):
    top = keyed.filter("k in ('a', 'hot')").select("k").unionByName(keyed.filter("k is null").select("k"))
    want = bag(keyed.filter("k in ('a', 'hot')"))
    found = semi_join_top(keyed, top, "k")
    assert bag(found) == want
    assert "IN (" in found._jdf.queryExecution().optimizedPlan().toString().upper().replace("INSET", "IN (")
    monkeypatch.setattr("pluvio.operators.joins.FILTER_KEYS", 1)
    assert bag(semi_join_top(keyed, top, "k")) == want
    assert semi_join_top(keyed, top.limit(0), "k").count() == 0


def test_broadcast_is_measured(keyed, monkeypatch):
    assert "broadcast" in measured_broadcast(keyed)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr("pluvio.operators.joins.BROADCAST_BYTES", 100)
    assert "broadcast" not in measured_broadcast(keyed)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_split_of_each_class_on_any_partitioning(spark, parts):
    rng = random.Random(3)
    # a third of the rows are copies of one row; some keys are null or shared by rows of different content
    rows = [(5, "Yes", 1.0)] * 400 + [(rng.randrange(300), rng.choice(["Yes", "No", None]), float(i % 3)) for i in range(800)] + [(None, "No", 2.0)] * 9
    df = spark.createDataFrame(rows, "h int, RainTomorrow string, x double").repartition(parts)
    got = exact_stratified(df, ratio=0.8)
    assert bag(got.drop("split")) == Counter(rows)
    n, train = Counter(r[1] for r in rows), Counter(r[1] for r in got.filter("split = 'train'").collect())
    assert train == Counter({c: math.floor(0.8 * k + 0.5) for c, k in n.items()})
    assert bag(got) == bag(exact_stratified(df.repartition(3), ratio=0.8))
    for ratio in (0.0, 1.0):
        sides = Counter(r["split"] for r in exact_stratified(df, ratio=ratio).collect())
        assert sides == Counter({"train" if ratio else "test": len(rows)})
    assert exact_stratified(df.filter("false")).count() == 0


def binned_rows(spark, n=3000):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(9), rng.randrange(7), rng.randrange(5)
        p = (0.9 if b > 2 else 0.2) if a > 4 else (0.8 if c > 2 else 0.1)
        rows.append((a, b, c, int(rng.random() < p), i % 4))
    return spark.createDataFrame(rows, "a int, b int, c int, label int, fold int").cache()


def test_histogram_tree_splits_as_the_fitted_classifier(spark, tmp_path):
    binned = binned_rows(spark)
    features = ["a", "b", "c"]
    grown = {r["node"]: r for r in histogram.grow(binned, features, depth=2).collect()}
    frame = VectorAssembler(inputCols=features, outputCol="features").transform(binned.withColumn("label", F.col("label").cast("double")))
    fitted = DecisionTreeClassifier(maxDepth=2, maxBins=32).fit(frame)
    nodes = {r["id"]: r for r in model_table.node_table(fitted, str(tmp_path / "tree")).collect()}
    seen, queue = set(), [(0, 1)]
    while queue:
        at, mine = queue.pop()
        if nodes[at]["feature"] is None:
            continue
        seen.add(mine)
        assert grown[mine]["feature"] == features[nodes[at]["feature"]] and grown[mine]["bin"] == math.floor(nodes[at]["threshold"])
        assert [grown[mine]["n"] - grown[mine]["positive"], grown[mine]["positive"]] == nodes[at]["counts"]
        queue += [(nodes[at]["left"], 2 * mine), (nodes[at]["right"], 2 * mine + 1)]
    assert set(grown) == {1, 2, 3} and len(seen) > 1
    # the classifier merges leaves of one split that predict the same class
    ends = binned.withColumn("node", histogram.node_of([(r["node"], r["feature"], r["bin"]) for r in grown.values()]))
    share = {r["node"]: r["share"] for r in ends.groupBy("node").agg(F.avg("label").alias("share")).collect()}
    assert all((share[2 * k] > 0.5) == (share[2 * k + 1] > 0.5) for k in set(grown) - seen)


def test_fold_splits_equal_those_of_each_training_side(spark):
    binned = binned_rows(spark, 800)
    got = {(r["fold"], r["feature"]): tuple(r)[2:] for r in histogram.fold_splits(binned, ["a", "b", "c"], 4).collect()}
    for fold in range(4):
        for feature in "abc":
            own = histogram.grow(binned.filter(F.col("fold") != fold), [feature], depth=1).collect()[0]
            assert got[fold, feature] == (own["bin"], own["n"], own["positive"], pytest.approx(own["gain"], abs=1e-12))


def test_bins_of_nulls_and_cuts(spark):
    df = spark.createDataFrame([(0, None), (1, float("nan")), (2, -1.0), (3, 0.0), (4, 5.0)], "i int, x double")
    assert [r["x"] for r in histogram.bin_columns(df, {"x": [0, 3]}, ["i"]).orderBy("i").collect()] == [0, 0, 1, 2, 3]
    assert histogram.grow(df.filter("false").selectExpr("int(x) a", "i label"), ["a"]).count() == 0


@pytest.mark.parametrize("kind", ["tree", "forest"])
def test_scores_by_the_node_table_equal_transform(spark, tmp_path, kind):
    binned = binned_rows(spark, 1500)
    frame = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(binned.withColumn("label", F.col("label").cast("double")))
    frame = frame.withColumn("i", F.monotonically_increasing_id()).cache()
    model = models.fit_tree(frame, maxDepth=4) if kind == "tree" else models.fit_forest(frame, numTrees=5, maxDepth=4, seed=1)
    nodes = model_table.node_table(model, str(tmp_path / kind))
    nodes.write.parquet(str(tmp_path / "nodes"))
    stored = spark.read.parquet(str(tmp_path / "nodes"))
    reloaded = models.load_model(str(tmp_path / kind), kind)
    for fitted in (model, reloaded):
        want = {r["i"]: r for r in fitted.transform(frame).select("i", "prediction", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p")).collect()}
        got = model_table.score_by_nodes(frame, stored, keep=["i"]).collect()
        assert len(got) == len(want)
        for r in got:
            assert r["prediction"] == want[r["i"]]["prediction"]
            assert r["rawPrediction"] == pytest.approx(want[r["i"]]["raw"], abs=1e-12) and r["probability"] == pytest.approx(want[r["i"]]["p"], abs=1e-12)
