"""Model-ready features: row means, column drop, vector, label index."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_DROP, ROW_MEANS, WEATHER, Roles
from ..functions.columns import row_mean


def with_row_means(df: DataFrame, spec: dict = ROW_MEANS) -> DataFrame:
    """E.g. Temp_avg = mean of the four temperatures (null if any is null)."""
    return df.withColumns({out: row_mean(ins) for out, ins in spec.items()})


def feature_columns(df: DataFrame, label: str, drop: Sequence[str] = FEATURE_DROP,
                    extra_drop: Sequence[str] = ("h",)) -> list[str]:
    """Every column except the label and the dropped ones (absent names tolerated)."""
    gone = set(drop) | set(extra_drop) | {label}
    return [c for c in with_row_means(df).columns if c not in gone]


def index_label_expr(label: str, order: Sequence[str]):
    """Label index as a plain expression: position in ``order`` (F2 in SQL form)."""
    expr = F.lit(None).cast("double")
    for i, v in enumerate(order):
        expr = F.when(F.col(label) == v, F.lit(float(i))).otherwise(expr)
    return expr


def feature_pipeline(inputs: Sequence[str], label: str = "RainTomorrow",
                     features_col: str = "features") -> Pipeline:
    """Row means → vector → label index (alphabetically descending: Yes=0, No=1)."""
    means = ", ".join(f"({' + '.join(ins)}) / {float(len(ins))} AS {out}" for out, ins in ROW_MEANS.items())
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {means} FROM __THIS__"),
        VectorAssembler(inputCols=list(inputs), outputCol=features_col, handleInvalid="keep"),
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetDesc"),
    ])


def build_features(train: DataFrame, spec: Roles = WEATHER) -> PipelineModel:
    """Fits the feature pipeline on the train side (F4); reuse it on test."""
    inputs = feature_columns(train, spec.label)
    return feature_pipeline(inputs, spec.label).fit(train)


def model_frame(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(features, label) rows for estimators."""
    return model.transform(df).select("features", "label")


def label_names(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].labels)


def label_map(df: DataFrame, labels: Sequence[str], index_col: str = "label", out: str = "label_name") -> DataFrame:
    """Index → original class."""
    return IndexToString(inputCol=index_col, outputCol=out, labels=list(labels)).transform(df)
