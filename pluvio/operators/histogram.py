"""Decision-tree splits from class counts per feature bin: level by level, and for all folds at once.

A level is one aggregate of (node, feature, bin) class counts; gains come from
prefix sums over a feature's bins. Only the splits chosen (one per node) reach the
driver. With folds, one aggregate holds every fold's counts, and a fold's training
side is the total minus its own.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_columns(df: DataFrame, cuts: Mapping[str, Sequence[float]], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and, per feature, its bin: 0 for null or NaN, else one more than the cuts that its value reaches."""
    out = []
    for c, own in cuts.items():
        x = F.col(c).cast("double")
        reached = reduce(lambda a, b: a + b, [(x >= F.lit(float(cut))).cast("int") for cut in own], F.lit(1))
        out.append(F.when(x.isNull() | F.isnan(x), 0).otherwise(reached).alias(c))
    return df.select(*keep, *out)


def bin_counts(binned: DataFrame, features: Sequence[str], by: Sequence[str], counts: Mapping[str, Column]) -> DataFrame:
    """by + (feature, bin) + ``counts``; combined before the shuffle, so no more rows than nodes x bins leave a task."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("bin")) for c in features])).alias("_e")
    flat = binned.select("*", each).select(*[c for c in binned.columns if c not in features], "_e.*")
    return flat.groupBy(*by, "feature", "bin").agg(*[v.alias(k) for k, v in counts.items()])


def gini(n: Column, positive: Column) -> Column:
    return 1 - (positive * positive + (n - positive) * (n - positive)) / (n * n)


def split_gains(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by + (feature, bin, n, positive, gain): what it gains to send bins up to ``bin`` to the left; splits with an empty side are left out."""
    over = Window.partitionBy(*by, "feature")
    upto = over.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(*by, "feature", "bin", F.sum("n").over(upto).cast("double").alias("ln"), F.sum("positive").over(upto).cast("double").alias("lp"),
                         F.sum("n").over(over).cast("double").alias("an"), F.sum("positive").over(over).cast("double").alias("ap"))
    n, p, ln, lp = (F.col(c) for c in ("an", "ap", "ln", "lp"))
    gain = gini(n, p) - ln / n * gini(ln, lp) - (n - ln) / n * gini(n - ln, p - lp)
    return (sums.filter((ln > 0) & (ln < n))
            .select(*by, "feature", "bin", n.cast("long").alias("n"), p.cast("long").alias("positive"), gain.alias("gain")))


def best_splits(gains: DataFrame, by: Sequence[str]) -> DataFrame:
    """The split of the highest gain (to 12 places; then the first feature by name, then the lowest bin) of each ``by``; none without gain."""
    order = Window.partitionBy(*by).orderBy(F.desc(F.round("gain", 12)), "feature", "bin")
    return gains.filter(F.round("gain", 12) > 0).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def node_of(splits: Sequence[tuple[int, str, int]]) -> Column:
    """A binned row's node after the given (node, feature, bin) splits: 1 at the root, 2k left and 2k + 1 right of k."""
    node = F.lit(1)
    for parent, feature, at in sorted(splits):
        node = F.when(node == parent, F.when(F.col(feature) <= at, 2 * parent).otherwise(2 * parent + 1)).otherwise(node)
    return node


def grow(binned: DataFrame, features: Sequence[str], label: str = "label", depth: int = 2) -> DataFrame:
    """(node, feature, bin, n, positive, gain) of the splits of a tree of ``depth`` levels; ``label`` is 0 or 1, rows without one take no part.

    Each level is one pass over ``binned``; its chosen splits, at most 2 ** level, become literals of the next.
    """
    rows = binned.filter(F.col(label).isNotNull())
    chosen: list[tuple[int, str, int]] = []
    found = []
    for level in range(depth):
        nodes = rows.withColumn("node", node_of(chosen)).filter(F.col("node") >= 2 ** level)
        counts = bin_counts(nodes, features, ["node"], {"n": F.count(F.lit(1)), "positive": F.sum(F.col(label).cast("long"))})
        best = best_splits(split_gains(counts, ["node"]), ["node"]).select("node", "feature", "bin", "n", "positive", "gain").collect()
        if not best:
            break
        found += [tuple(r) for r in best]
        chosen += [(r["node"], r["feature"], r["bin"]) for r in best]
    return binned.sparkSession.createDataFrame(found, "node int, feature string, bin int, n long, positive long, gain double")


def fold_splits(binned: DataFrame, features: Sequence[str], k: int, fold: str = "fold", label: str = "label") -> DataFrame:
    """(fold, feature, bin, n, positive, gain): each feature's best root split on the training side of every fold, from one aggregate."""
    rows = binned.filter(F.col(label).isNotNull())
    positive = F.col(label).cast("long")
    counts = {"n": F.count(F.lit(1)), "positive": F.sum(positive)}
    for f in range(k):
        counts[f"n{f}"] = F.count_if(F.col(fold) == f)
        counts[f"p{f}"] = F.coalesce(F.sum(F.when(F.col(fold) == f, positive)), F.lit(0))
    table = bin_counts(rows, features, [], counts)
    sides = F.array(*[F.struct(F.lit(f).alias("fold"), (F.col("n") - F.col(f"n{f}")).alias("n"), (F.col("positive") - F.col(f"p{f}")).alias("positive")) for f in range(k)])
    train = table.select("feature", "bin", F.explode(sides).alias("s")).select("feature", "bin", "s.*").filter("n > 0")
    return best_splits(split_gains(train, ["fold"]), ["fold", "feature"]).select("fold", "feature", "bin", "n", "positive", "gain")
