"""Final cleaning, retention, daily aggregates, cyclic month, bins, scaling."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import ROW_MEANS, WEATHER, Roles
from ..functions.columns import cyclic_month, row_mean
from ..session import materialize
from .explore import numeric_long
from .outliers import drop_outlier_rows, fences, iqr_bounds
from .selection import select_quantiles


def clean_final(df: DataFrame, fit: DataFrame | None = None, cloud_cols: Sequence[str] = ("Cloud9am", "Cloud3pm"),
                outlier_cols: Sequence[str] = ("Evaporation",), spec: Roles = WEATHER) -> DataFrame:
    """Drop rows with cloud = 9 (nulls kept) and rows outside the
    Evaporation fence fitted on ``fit`` (default: ``df``)."""
    cond = F.lit(True)
    for c in cloud_cols:
        cond = cond & F.coalesce(F.col(c) != 9, F.lit(True))
    bounds = fences(iqr_bounds(fit if fit is not None else df, outlier_cols, spec=spec))
    return drop_outlier_rows(df.filter(cond), bounds, outlier_cols)


def retention(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, n_rows, n_dropped, pct_kept) per named stage vs the previous one.

    Each stage is counted by its own aggregate; the small per-stage rows are
    then ordered by stage position. :class:`Passage` counts stages as they are written.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(i).alias("pos"), F.lit(name).alias("stage"), "n_rows")
             for i, (name, df) in enumerate(stages)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    from pyspark.sql import Window
    w = Window.orderBy("pos")  # one row per stage
    prev = F.lag("n_rows").over(w)
    return out.select("stage", "n_rows", F.coalesce(prev - F.col("n_rows"), F.lit(0)).alias("n_dropped"),
                      F.round(F.try_divide(F.col("n_rows") * 100.0, prev), 6).alias("pct_kept"))


class Passage:
    """Retention counted while stages are written (R8), without a scan of their own.

    ``write(name, df)`` stores the stage and observes its rows on the way; ``table()``
    compares each with the one before, as :func:`retention` does. The counter is the
    last step before the files, so only tasks whose files count add to it, even where
    an executor is lost and its tasks run again.
    """

    def __init__(self) -> None:
        self.stages: list[tuple[str, Observation]] = []

    def write(self, name: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"rows of {name}")
        self.stages.append((name, seen))
        return materialize(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows, n_dropped, pct_kept), one row per stage written."""
        counts = [(name, seen.get["n_rows"]) for name, seen in self.stages]
        rows = [(name, n, was - n if k else 0, round(n * 100.0 / was, 6) if k and was else None)
                for k, ((name, n), (_, was)) in enumerate(zip(counts, [(None, 0), *counts]))]
        return spark.createDataFrame(rows, "stage string, n_rows long, n_dropped long, pct_kept double")


def unclassified_rate(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """(n_rows, n_unclassified, pct): rows with a null feature cannot be scored."""
    bad = F.lit(False)
    for c in feature_cols:
        bad = bad | F.col(c).isNull()
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_unclassified"))
    return agg.select("n_rows", "n_unclassified",
                      F.round(F.try_divide(F.col("n_unclassified") * 100.0, F.col("n_rows")), 6).alias("pct"))


def daily_means(df: DataFrame) -> DataFrame:
    """Row means of temperature, pressure, humidity, wind speed and clouds."""
    spec = {**ROW_MEANS, "Cloud_avg": ("Cloud9am", "Cloud3pm")}
    return df.withColumns({k: row_mean(v) for k, v in spec.items()})


def with_cyclic_month(df: DataFrame, col: str = "Month") -> DataFrame:
    """Month_sin, Month_cos of 2π(m−1)/12."""
    return df.withColumns({k: v for k, v in cyclic_month(col).items()})


def quantile_splits(fit: DataFrame, cols: Sequence[str], n: int = 10, stored: bool = False) -> dict:
    """Distinct inner cut points per column at probabilities 1/n … (n−1)/n (a few numbers each, none for
    a column without values), exact as with ``QuantileDiscretizer(relativeError=0)``; ``stored`` as in ``select_quantiles``."""
    found = select_quantiles(fit, cols, [i / n for i in range(1, n)], stored=stored).get((), {})
    return {c: sorted({x for x in found.get(c, []) if x is not None}) for c in cols}


def quantile_bins(df: DataFrame, splits: dict, suffix: str = "_bin") -> DataFrame:
    """bin = number of cut points ≤ value (≤ n bins; equal cuts merge)."""
    out = {}
    for c, cuts in splits.items():
        b = sum((F.when(F.col(c) >= F.lit(float(x)), 1).otherwise(0) for x in cuts), F.lit(0))
        out[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), b.cast("double"))
    return df.withColumns(out)


def scaler_stats(fit: DataFrame, cols: Sequence[str]) -> dict:
    """Mean and sample stddev per column (two numbers each), fitted once."""
    rows = (numeric_long(fit, cols).groupBy("column_name")
            .agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect())
    found = {r["column_name"]: (r["m"], r["s"]) for r in rows}
    return {c: found.get(c, (None, None)) for c in cols}


def standardize(df: DataFrame, stats: dict, suffix: str = "_std") -> DataFrame:
    """(x − mean) / stddev with train statistics; zero or undefined stddev → 0."""
    out = {}
    for c, (m, s) in stats.items():
        if m is None:  # no value to fit on
            out[f"{c}{suffix}"] = F.lit(None).cast("double")
        elif s is None or s == 0 or math.isnan(s):
            out[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            out[f"{c}{suffix}"] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


def model_sets(train: DataFrame, test: DataFrame, cols: Sequence[str], n_bins: int = 10,
               label: str = "label", stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """``features_linear`` (standardised + cyclic month) and ``features_binned``
    (quantile bins), both fitted on train and applied to both sides; ``stored`` says that ``train`` reads files."""
    stats = scaler_stats(train, cols)
    splits = quantile_splits(train, cols, n_bins, stored)

    def build(df: DataFrame) -> DataFrame:
        x = quantile_bins(standardize(with_cyclic_month(df), stats), splits)
        lin = VectorAssembler(inputCols=[f"{c}_std" for c in cols] + ["Month_sin", "Month_cos"],
                              outputCol="features_linear", handleInvalid="keep")
        binned = VectorAssembler(inputCols=[f"{c}_bin" for c in cols], outputCol="features_binned",
                                 handleInvalid="keep")
        return binned.transform(lin.transform(x))

    return build(train), build(test)
