"""Descriptive statistics and exploration (one aggregate per family)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AUDIT_TOKENS, WEATHER, Roles
from ..functions.predicates import is_missing, is_null, number, parse_date
from .selection import quantile_frame, select_quantiles

#: Columns that one aggregate of the summary holds.
SUMMARY_COLUMNS = 16


def numeric_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, x) rows: one double value per listed column and row."""
    return (df.select(*[number(c).alias(c) for c in cols])
              .unpivot([], list(cols), "column_name", "x"))


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(column_name, min, max, mean, stddev) per column, sorted by name; nulls and NaN ignored, at full precision.

    One aggregate per SUMMARY_COLUMNS columns, whose single row is unpivoted;
    rows are not multiplied.
    """
    cols = [c for c in (cols or spec.audit_numeric) if c in df.columns]
    parts = []
    for k in range(0, len(cols), SUMMARY_COLUMNS):
        own = cols[k:k + SUMMARY_COLUMNS]
        wide = df.select(*[number(c).alias(c) for c in own]).agg(*[
            F.struct(F.min(F.col(f"`{c}`")).alias("min"), F.max(F.col(f"`{c}`")).alias("max"), F.avg(F.col(f"`{c}`")).alias("mean"),
                     F.stddev_samp(F.col(f"`{c}`")).alias("stddev")).alias(c) for c in own])
        parts.append(wide.unpivot([], own, "column_name", "s").select("column_name", "s.*"))
    return reduce(DataFrame.unionByName, parts).orderBy("column_name")


def prob_name(p: float) -> str:
    return f"p{round(p * 100):02d}"


def percentiles(df: DataFrame, cols: Sequence[str] | None = None,
                probs: Sequence[float] = (0.01, 0.05, 0.50, 0.95, 0.99),
                accuracy: int | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(column_name, p01, ...) per column over non-null values.

    Exact by default (distributed selection); with
    ``accuracy`` a ``percentile_approx`` sketch is used (the reference's
    relative error 0.01 is accuracy 100). Columns without values are skipped.
    """
    cols = [c for c in (cols or spec.audit_numeric) if c in df.columns]
    if accuracy:
        parr = F.array(*[F.lit(float(p)) for p in probs])
        q = (numeric_long(df, cols).filter(F.col("x").isNotNull())
             .groupBy("column_name").agg(F.percentile_approx("x", parr, accuracy).alias("q")))
    else:
        q = quantile_frame(df.sparkSession, select_quantiles(df, cols, list(probs)))
    return q.select("column_name", *[F.col("q")[i].alias(prob_name(p)) for i, p in enumerate(probs)])


def median(c: str) -> Column:
    """Aggregate: the exact lower median (A3)."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)")


def valid_label(df: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """Rows whose label is in the label domain."""
    return df.filter(F.col(spec.label).isin(*spec.label_domain))


def class_balance(df: DataFrame, label: str | None = None, domain: Sequence[str] | None = None,
                  spec: Roles = WEATHER) -> DataFrame:
    """(label, n, pct) over rows with a valid label, most frequent first."""
    label = label or spec.label
    domain = domain or spec.label_domain
    counts = df.filter(F.col(label).isin(*domain)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # at most len(domain) rows
    return order_by_count(counts.select(label, "n", F.round(F.col("n") * 100.0 / total, 6).alias("pct")), ties=[label])


def majority_baseline(df: DataFrame, label: str | None = None, domain: Sequence[str] | None = None,
                      spec: Roles = WEATHER) -> DataFrame:
    """(majority_label, n_majority, n_total, accuracy) of always predicting the top class."""
    label = label or spec.label
    domain = domain or spec.label_domain
    counts = df.filter(F.col(label).isin(*domain)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    agg = counts.agg(F.max_by(label, F.struct("n", label)).alias("majority_label"),
                     F.max("n").alias("n_majority"), F.sum("n").alias("n_total"))
    return agg.select("majority_label", "n_majority", "n_total",
                      F.try_divide(F.col("n_majority").cast("double"), F.col("n_total")).alias("accuracy"))


def _values_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], list(cols), "column_name", "value"))


def cardinality(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                spec: Roles = WEATHER) -> DataFrame:
    """(column_name, n_distinct) of non-null values for several columns at once."""
    cols = [c for c in (cols or spec.categorical) if c in df.columns]
    long = _values_long(df, cols).filter(~is_null("value"))
    if approx:
        return long.groupBy("column_name").agg(F.approx_count_distinct("value").alias("n_distinct"))
    return (long.distinct()
                .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))


def value_counts(df: DataFrame, cols: Sequence[str], keep_null: bool = False, drop_missing: bool = False) -> DataFrame:
    """(column_name, value, n); ``drop_missing`` leaves out nulls and the audit's missing tokens."""
    long = _values_long(df, cols)
    if drop_missing:
        long = long.filter(~is_missing("value", AUDIT_TOKENS, "string"))
    elif not keep_null:
        long = long.filter(~is_null("value"))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def top_k(df: DataFrame, cols: Sequence[str] | None = None, k: int = 10, spec: Roles = WEATHER, drop_missing: bool = False) -> DataFrame:
    """(column_name, value, n, rank): the k most frequent non-null values per column.

    A missing token ("NA") is a category unless ``drop_missing`` leaves such values out.

    The rank filter becomes a WindowGroupLimit, so each map task keeps only
    its local top k per column before the shuffle.
    """
    cols = [c for c in (cols or spec.categorical) if c in df.columns]
    w = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    return (value_counts(df, cols, drop_missing=drop_missing).withColumn("rank", F.row_number().over(w))
                                  .filter(F.col("rank") <= k))


def rare_categories(df: DataFrame, cols: Sequence[str] | None = None, threshold: int = 50,
                    spec: Roles = WEATHER, drop_missing: bool = False) -> DataFrame:
    """(column_name, value, n) for values seen fewer than ``threshold`` times; null and missing
    tokens are values too unless ``drop_missing`` leaves them out."""
    cols = [c for c in (cols or spec.categorical) if c in df.columns]
    return value_counts(df, cols, keep_null=True, drop_missing=drop_missing).filter(F.col("n") < threshold)


def with_month(df: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    is_text = dict(df.dtypes)[spec.date] == "string"
    return df.withColumn("Month", F.month(parse_date(spec.date, spec.date_format, is_text)))


def rate_by(df: DataFrame, keys: Sequence[str], label: str | None = None, positive: str | None = None,
            spec: Roles = WEATHER) -> DataFrame:
    """(keys..., rate, n): share of the positive class per group over valid labels."""
    label = label or spec.label
    positive = positive or spec.positive
    v = valid_label(df, spec)
    rates = v.groupBy(*keys).agg(F.avg(F.when(F.col(label) == positive, 1).otherwise(0)).alias("rate"), F.count(F.lit(1)).alias("n"))
    return order_by_key(rates, keys)


def rate_by_top(df: DataFrame, key: str | None = None, k: int = 10, label: str | None = None,
                positive: str | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(key, rate, n) for the k most frequent keys: one grouping, then top-k."""
    key = key or spec.location
    per = rate_by(df, [key], label, positive, spec)
    return order_by_count(per, ties=[key]).limit(k)


# Sorts, limits and set operations (L1-L3, U1-U4) --------------------------

def order_by_count(df: DataFrame, count_col: str = "n", ties: Sequence[str] = ()) -> DataFrame:
    """Largest counts first (L1); ``ties`` decide among equal ones."""
    return df.orderBy(F.desc(count_col), *ties)


def order_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ascending keys, nulls first (L2)."""
    return df.orderBy(*keys)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(~is_null(col)).distinct()


def outside_domain(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """Distinct non-null values of ``col`` not in ``domain`` (set difference)."""
    return distinct_values(df, col).where(~F.col(col).isin(*domain))


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)
