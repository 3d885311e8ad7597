"""A fitted tree or forest as a table of nodes, and scoring by it in plain expressions."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .models import save_model


def node_table(model: Model, path: str) -> DataFrame:
    """Save the model under ``path``; (tree, id, feature, threshold, left, right, prediction, counts) of its nodes.

    ``feature`` and ``threshold`` are null in leaves; a row goes left where its
    feature is at most the threshold; ``counts`` are the training rows of each class. Continuous features only.
    """
    save_model(model, path)
    return read_nodes(model_session(model), path)


def model_session(model: Model) -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``node_table`` of a model that was saved before, forest or tree."""
    data = spark.read.parquet(f"{path}/data")
    nodes = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.select(F.lit(0).alias("tree"), "*")
    split = F.col("leftChild") >= 0
    if nodes.filter(split & (F.col("split.numCategories") >= 0)).limit(1).count():
        raise ValueError("splits on categories are not supported")
    return nodes.select("tree", "id", F.when(split, F.col("split.featureIndex")).alias("feature"),
                        F.when(split, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
                        F.when(split, F.col("leftChild")).alias("left"), F.when(split, F.col("rightChild")).alias("right"),
                        "prediction", F.col("impurityStats").alias("counts"))


def score_by_nodes(df: DataFrame, nodes: DataFrame, features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` with prediction, rawPrediction and probability (arrays): what the fitted model's ``transform`` gives.

    The nodes, as many as the model has, become one CASE expression per tree;
    a tree's raw values are its leaf's counts, a forest's the sum of its trees' shares.
    """
    trees: dict[int, dict[int, dict]] = {}
    for row in nodes.collect():
        trees.setdefault(row["tree"], {})[row["id"]] = row.asDict()
    x = F.col("_x")

    def leaf(tree: dict[int, dict], at: int) -> Column:
        node = tree[at]
        if node["feature"] is None:
            counts = node["counts"]
            return F.array(*[F.lit(float(c) if len(trees) == 1 else c / sum(counts)) for c in counts])
        return F.when(x[node["feature"]] <= F.lit(node["threshold"]), leaf(tree, node["left"])).otherwise(leaf(tree, node["right"]))

    raw = None
    for _, tree in sorted(trees.items()):
        own = leaf(tree, 0)
        raw = own if raw is None else F.zip_with(raw, own, lambda a, b: a + b)
    scored = df.withColumn("_x", vector_to_array(features)).select(*keep, raw.alias("rawPrediction"))
    total = F.aggregate("rawPrediction", F.lit(0.0), lambda a, b: a + b)
    first = F.array_position("rawPrediction", F.array_max("rawPrediction")) - 1
    return scored.select(*keep, first.cast("double").alias("prediction"), "rawPrediction",
                         F.transform("rawPrediction", lambda v: F.when(total == 0, 0.0).otherwise(v / total)).alias("probability"))
