"""Tree and forest classifiers, cross-validated tuning, scoring."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool
from typing import Sequence
from uuid import uuid4

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, stages
from . import fold_trees


def fit_tree(df: DataFrame, **params) -> DecisionTreeClassificationModel:
    """M1: decision tree on (features, label)."""
    return DecisionTreeClassifier(**params).fit(df)


# Forest configuration of the reference script (fixed values).
FOREST_DEFAULTS = dict(numTrees=10, maxDepth=7, maxBins=20, minInstancesPerNode=1,
                       minInfoGain=0.0, cacheNodeIds=False, checkpointInterval=10)


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{**FOREST_DEFAULTS, **params})


def fit_forest(df: DataFrame, **params) -> RandomForestClassificationModel:
    """M2: random forest with the reference's defaults unless overridden."""
    return forest(**params).fit(df)


def param_grid(est: Estimator, grid: dict) -> list:
    """M3: ``{"maxDepth": [3, 5]}`` → list of param maps."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


class _FoldValidator(CrossValidator):
    """CrossValidator by a fold column, which is checked once in an aggregate instead of by a Python function on every row of every fold."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        return _folds(dataset, self.getFoldCol(), self.getNumFolds())


def _folds(df: DataFrame, fold_col: str, k: int) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) of each fold; every row's fold must be in [0, k), and no side empty."""
    fold = F.col(fold_col)
    counts = {r[0]: r[1] for r in df.groupBy(F.when(fold.between(0, k - 1), fold).alias("fold")).count().collect()}
    if None in counts:
        raise ValueError(f"{fold_col} must be in the range [0, {k})")
    for i in range(k):
        if not counts.get(i):
            raise ValueError(f"the validation data of fold {i} is empty")
        if counts[i] == sum(counts.values()):
            raise ValueError(f"the training data of fold {i} is empty")
    return [(df.filter(fold != i), df.filter(fold == i)) for i in range(k)]


def cross_validate(df: DataFrame, est: Estimator, grid: dict, k: int = 5, parallelism: int = 2,
                   fold_col: str | None = None, seed: int = 2025) -> CrossValidatorModel:
    """M4: k-fold CV on areaUnderROC; ``fold_col`` gives reproducible folds.

    Decision trees that differ in their depth alone are fitted once, at the greatest one (see :func:`_share_depths`). Forests, and trees
    of many rows, are grown for all folds and settings at once (see :mod:`.fold_trees`), which gives the same trees.
    """
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC")
    kind = _FoldValidator if fold_col else CrossValidator
    cv = kind(estimator=est, estimatorParamMaps=param_grid(est, grid), evaluator=evaluator,
              numFolds=k, parallelism=parallelism, seed=seed)
    if not fold_col:
        return cv.fit(df)
    cv = cv.setFoldCol(fold_col)
    found = _grow_folds(df, cv)
    if found:
        return found
    if type(est) is DecisionTreeClassifier and max(grid.get("maxDepth", [MAX_SHARED + 1])) <= MAX_SHARED:
        return _share_depths(df, cv)
    return cv.fit(df)


#: Depth up to which a tree's scores are fewer than those that the evaluator would merge to its 1000 bins.
MAX_SHARED = 10


def _share_depths(df: DataFrame, cv: CrossValidator) -> CrossValidatorModel:
    """``cv.fit(df)`` with one fit per fold for all depths of otherwise equal settings.

    A tree grows level by level and its splits don't depend on its maximal depth, so the tree of
    a smaller one is the deepest tree cut there. One pass over the validation rows counts them by
    leaf of the deepest tree and label; from these counts come the areas of all depths.
    """
    est, maps = cv.getEstimator(), cv.getEstimatorParamMaps()
    depth = est.getParam("maxDepth")
    alike: dict[tuple, list[int]] = {}
    for i, pm in enumerate(maps):
        alike.setdefault(tuple(sorted((p.name, v) for p, v in pm.items() if p != depth)), []).append(i)
    areas = np.zeros((cv.getNumFolds(), len(maps)))
    pool = ThreadPool(min(cv.getParallelism(), len(alike)))
    for fold, (training, validation) in enumerate(_folds(df, cv.getFoldCol(), cv.getNumFolds())):
        training = training.cache()

        def fit(group: list[int]) -> None:
            model = est.fit(training, maps[max(group, key=lambda i: maps[i][depth])])
            seen = model.setLeafCol("_leaf").transform(validation).groupBy("_leaf", est.getLabelCol()).count().collect()
            nodes = _nodes(model, df.sparkSession)
            for i in group:
                areas[fold, i] = _area(_cut_scores(nodes, maps[i][depth]), seen)

        pool.map(inheritable_thread_target(df.sparkSession)(fit), list(alike.values()))
        training.unpersist()
    pool.close()
    average = areas.mean(axis=0)
    best = est.fit(df, maps[int(np.argmax(average))])
    return cv._copyValues(CrossValidatorModel(best, [float(x) for x in average], [], [float(x) for x in areas.std(axis=0)]))


#: Training rows from which a tree's folds are grown together; below it Spark's fits are faster. Forests always are.
MANY_ROWS = 1_000_000

#: Values that trees grown together have, beside those of the grid.
_GROWN = dict(featuresCol="features", labelCol="label", minInstancesPerNode=1, minInfoGain=0.0, minWeightFractionPerNode=0.0, maxMemoryInMB=256)
_GROWN_FOREST = dict(featureSubsetStrategy="auto", subsamplingRate=1.0, bootstrap=True)


def _grow_folds(df: DataFrame, cv: CrossValidator) -> CrossValidatorModel | None:
    """``cv.fit(df)`` with the trees of all folds and settings grown at once; None where :mod:`.fold_trees` doesn't hold."""
    est, maps = cv.getEstimator(), cv.getEstimatorParamMaps()
    is_forest = type(est) is RandomForestClassifier
    if not (is_forest or type(est) is DecisionTreeClassifier) or est.isDefined("weightCol") or est.isDefined("thresholds"):
        return None
    if {p.name for pm in maps for p in pm} - {"maxDepth", "maxBins", "impurity"} or any(
            est.getOrDefault(name) != value for name, value in {**_GROWN, **(_GROWN_FOREST if is_forest else {})}.items()):
        return None
    wanted = [tuple({**{n: est.getOrDefault(n) for n in ("maxBins", "impurity", "maxDepth")}, **{p.name: v for p, v in pm.items()}}.values()) for pm in maps]
    trees = est.getNumTrees() if is_forest else 1
    if not 1 < trees <= fold_trees.MOST_TREES if is_forest else max(d for _, _, d in wanted) > MAX_SHARED:
        return None
    if {"nominal", "binary"} & set(df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})):
        return None
    k, fold = cv.getNumFolds(), F.col(cv.getFoldCol())
    rows = df.groupBy(F.when(fold.between(0, k - 1), fold).alias("fold"), "label").agg(
        F.count(F.lit(1)), F.count_if(F.col("features").isNull())).collect()
    n = [[sum(r[2] for r in rows if r[0] == i and r[1] == value) for value in (0.0, 1.0)] for i in range(k)]
    total = np.sum(n, axis=0)
    if any(r[3] for r in rows) or total.sum() != sum(r[2] for r in rows) or any(sum(own) == 0 or (total - own).min() == 0 for own in n):
        return None
    if not is_forest and total.sum() < MANY_ROWS:
        return None
    kinds = sorted({(b, i) for b, i, _ in wanted})
    settings = [fold_trees.Setting(b, i, max(1, *(d for x, y, d in wanted if (x, y) == (b, i)))) for b, i in kinds]
    at = [(kinds.index((b, i)), d) for b, i, d in wanted]
    grown = fold_trees.FoldTrees(df, cv.getFoldCol(), [int(total.sum() - sum(own)) for own in n], settings, trees, est.getSeed(), is_forest)
    with stages(), grown:
        if not grown.grow():
            return None
        if is_forest:
            areas = _forest_areas(grown, cv, at)
        else:
            seen = grown.seen()
            areas = np.array([[_area(grown.trees[i][s][0].values(d, False), seen[i, s]) for s, d in at] for i in range(k)])
    average = areas.mean(axis=0)
    best = est.fit(df, maps[int(np.argmax(average))])
    return cv._copyValues(CrossValidatorModel(best, [float(x) for x in average], [], [float(x) for x in areas.std(axis=0)]))


def _forest_areas(grown: fold_trees.FoldTrees, cv: CrossValidator, at: Sequence[tuple[int, int]]) -> np.ndarray:
    """(fold, setting and depth) areas that the evaluator gives for the validation rows' scores."""
    evaluator, scored = cv.getEvaluator(), grown.scored(at)
    spark = scored.sparkSession
    places = [(i, c) for i in range(cv.getNumFolds()) for c in range(len(at))]
    with ThreadPool(cv.getParallelism()) as pool:
        found = pool.map(inheritable_thread_target(spark)(
            lambda own: evaluator.evaluate(scored.filter(F.col("fold") == own[0]).select("label", F.col(f"s{own[1]}").alias("rawPrediction")))), places)
    return np.array(found).reshape(-1, len(at))


def _nodes(model: DecisionTreeClassificationModel, spark: SparkSession) -> dict[int, tuple]:
    """{id: (class counts, left id, right id)} of a tree; the root's id is 0, a leaf's children are None."""
    from .model_table import node_table
    rows = node_table(model, f"{shared_dir(spark)}/pluvio-model-{uuid4().hex}").select("id", "counts", "left", "right").collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def _cut_scores(nodes: dict[int, tuple], depth: int) -> list[float]:
    """Score (positives) that the tree cut at ``depth`` gives to the rows of each leaf, in leaf order.

    As in a fit, two leaves that predict one class become a leaf of their parent.
    """
    def leaves(at: int) -> int:
        _, left, right = nodes[at]
        return 1 if left is None else leaves(left) + leaves(right)

    def cut(at: int, level: int) -> tuple[list[float], int | None]:
        """The scores below a node and, if it is a leaf after the cut, its class."""
        stats, left, right = nodes[at]
        own = int(np.argmax(stats))
        if left is None or level == depth:
            return [stats[1]] * leaves(at), own
        (a, x), (b, y) = cut(left, level + 1), cut(right, level + 1)
        if x is not None and x == y:
            return [stats[1]] * len(a + b), own
        return a + b, None
    return cut(0, 0)[0]


def _area(scores: Sequence[float], seen: Sequence) -> float:
    """Area under the ROC curve, by trapezoids, of (leaf, label, count) rows whose leaf has that score."""
    counts: dict[float, list[int]] = {}
    for leaf, label, n in seen:
        counts.setdefault(scores[int(leaf)], [0, 0])[int(label > 0.5)] += n
    total = np.cumsum([[0, 0], *(counts[s] for s in sorted(counts, reverse=True))], axis=0)
    rates = np.vstack([total / np.maximum(total[-1], 1), [1, 1]])
    return float(np.trapezoid(rates[:, 1], rates[:, 0]))


def cv_table(spark: SparkSession, cvm: CrossValidatorModel, stage: int = 1) -> DataFrame:
    """(stage, params, auc, best) per grid point: the search and, marked, what it chose (M6)."""
    rows = []
    chosen = max(range(len(cvm.avgMetrics)), key=lambda i: cvm.avgMetrics[i])
    for i, (pm, m) in enumerate(zip(cvm.getEstimatorParamMaps(), cvm.avgMetrics)):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((stage, text, float(m), i == chosen))
    return spark.createDataFrame(rows, "stage int, params string, auc double, best boolean")


def best_params(model: Model, names: Sequence[str] = ("impurity", "maxDepth", "maxBins", "numTrees")) -> dict:
    """M6: the chosen values of the tuned parameters."""
    out = {}
    for n in names:
        if model.hasParam(n):
            out[n] = model.getOrDefault(model.getParam(n))
    return out


def tune_two_stage(df: DataFrame, est: Estimator, coarse: dict, refine_bins: Sequence[int] = (), k: int = 5,
                   parallelism: int = 2, fold_col: str | None = None, carry: Sequence[str] = ("impurity",),
                   refine: dict | None = None):
    """M5: coarse grid, then depth ±1 around the best × ``refine_bins``, or the grid ``refine`` as it stands.

    The best values of ``carry`` parameters from stage 1 are kept in stage 2
    (the reference drops them; pass ``carry=()`` to reproduce that).
    Returns (stage-1 model, stage-2 model).
    """
    cv1 = cross_validate(df, est, coarse, k, parallelism, fold_col)
    best = best_params(cv1.bestModel)
    depth = best["maxDepth"]
    est2 = est.copy()
    for name in carry:
        if name in best and est2.hasParam(name):
            est2.set(est2.getParam(name), best[name])
    refine = refine or {"maxBins": list(refine_bins), "maxDepth": sorted({max(1, depth - 1), depth, depth + 1})}
    cv2 = cross_validate(df, est2, refine, k, parallelism, fold_col)
    return cv1, cv2


def score(model: Model, df: DataFrame) -> DataFrame:
    """M7: prediction, rawPrediction and probability columns."""
    return model.transform(df)


def save_model(model: Model, path: str) -> None:
    """Overwrite-save a fitted model."""
    model.write().overwrite().save(path)


def load_model(path: str, kind: str = "tree") -> Model:
    """Load a tree or forest model."""
    cls = DecisionTreeClassificationModel if kind == "tree" else RandomForestClassificationModel
    return cls.load(path)
