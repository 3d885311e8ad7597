"""Train → score → evaluate flows over a prepared (train, test) pair."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, metrics, models
from ..operators.split import assign_folds
from ..session import materialize
from .prepare import Preparation


def evaluate(pred: DataFrame, labels=(0.0, 1.0), bins: int = 17) -> DataFrame:
    """(metric, value) for one prediction frame: E1-E3, E5-E9, E11, E12, E14.

    The prediction frame is materialised once and every metric aggregates it.
    """
    p = materialize(pred.select("label", "prediction", vector_to_array("probability")[1].alias("score")))
    areas = metrics.curve_areas(p, "score", bins=bins).select(F.inline(F.array(
        F.struct(F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value")),
        F.struct(F.lit("auc_pr").alias("metric"), F.col("auc_pr").alias("value")))))
    hard = metrics.auc_roc(p, "prediction").select(F.lit("auc_roc_hard").alias("metric"), F.col("auc_roc").alias("value"))
    return metrics.classification_table(p, labels).unionByName(areas).unionByName(hard)


@dataclass
class Modelling:
    """Prepared data → feature pipeline → model frames (built once each)."""

    prep: Preparation
    k: int = 5
    _cache: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def pipeline(self) -> PipelineModel:
        return self._get("pipeline", lambda: features.build_features(self.prep.train_final, self.prep.spec))

    @property
    def train(self) -> DataFrame:
        """(h, features, label, fold) for training, materialised for repeated fits."""
        return self._get("train", lambda: materialize(assign_folds(
            self.pipeline.transform(self.prep.train_final).select("h", "features", "label"), self.k)))

    @property
    def test(self) -> DataFrame:
        """Test rows through the train-fitted pipeline (F5: no refit on scored data)."""
        return self._get("test", lambda: self.pipeline.transform(self.prep.test_final).select("h", "features", "label"))

    def tree(self, **params):
        return models.fit_tree(self.train, **params)

    def forest(self, **params):
        return models.fit_forest(self.train, **params)
