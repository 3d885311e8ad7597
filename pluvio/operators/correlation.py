"""Pearson correlation: matrix, feature-label, collinear pairs, coverage.

The matrix comes from one scan's mergeable centred products, feature and label are one aggregate of
Spark's streaming ``corr``, instead of one job per feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WEATHER, Roles
from ..functions.predicates import encode_binary, number
from .explore import valid_label


def _prepared(df: DataFrame, cols: Sequence[str], spec: Roles) -> DataFrame:
    """Valid-label rows, numeric columns as double, label as 0/1."""
    v = valid_label(df, spec)
    return v.select(*[number(c).alias(c) for c in cols],
                    encode_binary(spec.label, spec.positive).alias("label_num"))


#: Rows that partial moments are merged to before they reach the driver.
MERGED = 16


class Moments:
    """Count, means and centred products of complete rows; two of them merge exactly as if their rows had come together.

    A batch is centred on its first row, then on its mean, so that an offset far
    beyond the spread (1e9 and 1) loses nothing and equal values have a deviation of exactly 0.
    """

    def __init__(self, n: int, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        shifted = rows - rows[0]
        centre = shifted.mean(0)
        shifted -= centre
        return cls(len(rows), rows[0] + centre, shifted.T @ shifted)

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = other.mean - self.mean
        return Moments(n, self.mean + apart * (other.n / n), self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n))


def _merge(found: list[Moments]) -> Iterator[pa.RecordBatch]:
    if found:
        whole = reduce(Moments.merge, found)
        yield pa.RecordBatch.from_arrays([pa.array([whole.n], pa.int64()), pa.array([whole.mean], pa.list_(pa.float64())),
                                          pa.array([whole.products.ravel()], pa.list_(pa.float64()))], ["n", "mean", "products"])


def _rows_to_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[Moments] = []
    with np.errstate(all="ignore"):
        for batch in batches:
            if len(batch):
                own = Moments.of(np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in batch.schema.names]))
                found = [found[0].merge(own)] if found else [own]
        yield from _merge(found)


def _read_moments(rows) -> list[Moments]:
    made = [(r["n"], np.array(r["mean"], float), np.array(r["products"], float)) for r in rows]
    return [Moments(n, mean, products.reshape(len(mean), -1)) for n, mean, products in made]


def _moments_to_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(all="ignore"):
        yield from _merge([m for batch in batches for m in _read_moments(batch.to_pylist())])


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(col_a, col_b, r) for every pair i<j over listwise-complete rows.

    One scan: each task merges its batches' centred products (numpy on Arrow
    batches), these are merged in MERGED tasks and then on the driver, one value per
    pair of columns each. Rows are neither multiplied nor shuffled. r is null where
    a column is constant, holds an infinite value or only one row is complete;
    without complete rows there are no pairs.
    """
    cols = list(cols or spec.audit_numeric)
    complete = _prepared(df, cols, spec).na.drop(subset=cols).select(*[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)])
    schema = "n long, mean array<double>, products array<double>"
    partial = complete.mapInArrow(_rows_to_moments, schema).repartition(MERGED).mapInArrow(_moments_to_moments, schema)
    with np.errstate(all="ignore"):
        found = _read_moments(partial.collect())
        whole = reduce(Moments.merge, found) if found else None
        rows = []
        if whole:
            spread = np.sqrt(np.diag(whole.products))
            matrix = whole.products / spread[:, None] / spread[None, :]
            for i, j in combinations(range(len(cols)), 2):
                r = float(matrix[i, j])
                rows.append((cols[i], cols[j], None if math.isnan(r) or whole.n < 2 else r))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def corr_with_label(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(column_name, r): pairwise-complete corr with the 0/1 label, by |r| desc.

    Features with no usable rows (null r) are skipped.
    """
    cols = list(cols or spec.audit_numeric)
    p = _prepared(df, cols, spec)
    packed = p.agg(*[F.corr(c, "label_num").alias(c) for c in cols])
    long = packed.unpivot([], cols, "column_name", "r").filter(F.col("r").isNotNull() & ~F.isnan("r"))
    return long.orderBy(F.desc(F.abs("r")), "column_name")


def collinear_pairs(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.90,
                    spec: Roles = WEATHER) -> DataFrame:
    """Pairs of the correlation matrix with |r| >= threshold, strongest first."""
    m = corr_matrix(df, cols, spec)
    return m.filter(F.abs("r") >= threshold).orderBy(F.desc(F.abs("r")), "col_a", "col_b")


def corr_coverage(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(n_used, n_total, pct): rows entering the matrix over all rows, one pass."""
    cols = list(cols or spec.audit_numeric)
    ok = F.col(spec.label).isin(*spec.label_domain)
    for c in cols:
        v = F.col(c).try_cast("double")
        ok = ok & v.isNotNull() & ~F.isnan(v)
    agg = df.agg(F.count_if(ok).alias("n_used"), F.count(F.lit(1)).alias("n_total"))
    return agg.select("n_used", "n_total",
                      F.round(F.try_divide(F.col("n_used") * 100.0, F.col("n_total")), 6).alias("pct"))
