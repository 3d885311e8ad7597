"""Interquartile (Tukey) fences and nulling of values outside them."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WEATHER, Roles
from .explore import numeric_long
from .selection import quantile_frame, select_quantiles


def iqr_bounds(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5,
               accuracy: int | None = None, spec: Roles = WEATHER, stored: bool = False) -> DataFrame:
    """(column_name, q1, q3, lower, upper) over non-null values; one aggregate.

    Quartiles are exact (distributed selection; ``stored`` as there); pass
    ``accuracy`` to use a ``percentile_approx`` sketch instead (the
    reference's relative error 0.05 is accuracy 20). A column without values
    yields no row, and is then left unchanged.
    """
    cols = [c for c in (cols or spec.outliers) if c in df.columns]
    if accuracy:
        q = (numeric_long(df, cols).filter(F.col("x").isNotNull() & ~F.isnan("x"))
             .groupBy("column_name").agg(F.percentile_approx("x", F.array(F.lit(0.25), F.lit(0.75)), accuracy).alias("q")))
    else:
        q = quantile_frame(df.sparkSession, select_quantiles(df, cols, [0.25, 0.75], stored=stored))
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select("column_name", q1.alias("q1"), q3.alias("q3"),
                    (q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper"))


def fences(bounds: DataFrame) -> dict[str, tuple[float, float]]:
    """Collects the fence table: at most one row per checked column."""
    return {r["column_name"]: (r["lower"], r["upper"]) for r in bounds.collect()}


def null_outliers(df: DataFrame, bounds: DataFrame | dict) -> DataFrame:
    """Values outside [lower, upper] become null (type kept); rows are kept.

    The fitted fences are a handful of numbers (two per column), applied as
    literals in one projection, like a fitted ML model.
    """
    fx = bounds if isinstance(bounds, dict) else fences(bounds)
    dtypes = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in fx and fx[c][0] is not None:
            lo, hi = fx[c]
            out.append(F.when((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(None).cast(dtypes[c]))
                        .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def drop_outlier_rows(df: DataFrame, bounds: DataFrame | dict, cols: Sequence[str]) -> DataFrame:
    """Row filter: drop rows whose value lies outside the fence (nulls kept)."""
    fx = bounds if isinstance(bounds, dict) else fences(bounds)
    cond = F.lit(True)
    for c in cols:
        if c in fx and fx[c][0] is not None:
            lo, hi = fx[c]
            cond = cond & ~F.coalesce((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)), F.lit(False))
    return df.filter(cond)
