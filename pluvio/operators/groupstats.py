"""Grouped statistics and modes that feed the imputation tiers."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AUDIT_TOKENS, WEATHER, Roles
from ..functions.predicates import any_present, is_missing
from ..session import materialize
from .quantiles import exact_quantiles, sorted_medians
from .selection import select_quantiles

#: Rows of the largest group up to which a group's values may be held in one buffer.
GROUP_ROWS = 100_000


def _mean(c: str, decimals: int | None):
    m = F.avg(F.col(c))
    return F.round(m, decimals) if decimals is not None else m


def group_stats(df: DataFrame, keys: Sequence[str], mean_cols: Sequence[str] = (),
                median_cols: Sequence[str] = (), raw_mean_cols: Sequence[str] = (),
                presence_cols: Sequence[str] | None = None, medians: str = "exact_spread", accuracy: int = 10_000,
                mean_decimals: int | None = None, stored: bool = False) -> DataFrame:
    """keys + ``{c}_mean`` / ``{c}_median`` per group.

    Rows where every ``presence_cols`` value is null are ignored (as the
    reference does before grouping); NaN is a missing value. ``raw_mean_cols``
    keep unrounded means (discrete columns are rounded to integers later); a column
    may be in both ``mean_cols`` and ``median_cols``. ``mean_decimals`` rounds the former's means.
    ``medians`` names the way, and no size changes it: ``exact_spread`` counts
    values dealt over tasks, however many a group has, ``exact`` gives the same
    but holds the different values of a group in one buffer (for groups that are
    bounded), ``sorted`` sorts the rows by group and takes the medians in Arrow batches, one
    group at a time in a buffer (also for bounded groups), ``select`` finds them by passes over all columns at once (for few
    groups of any size, see :mod:`.selection`), ``measured`` counts the rows of
    each group first and takes ``sorted`` if none has more than GROUP_ROWS, else
    ``exact_spread``; all these give the same. ``sketch`` is approximate with ``accuracy``.
    ``stored`` says that ``df`` reads files, so that ``select`` doesn't store its columns again.
    """
    if medians not in ("exact", "exact_spread", "select", "sorted", "measured", "sketch"):
        raise ValueError(f"unknown medians {medians!r}")
    presence = list(presence_cols) if presence_cols is not None else [*mean_cols, *median_cols, *raw_mean_cols]
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in dict.fromkeys([*presence, *mean_cols, *median_cols, *raw_mean_cols]) if c in floats})
    src = df.filter(any_present(presence)) if presence else df
    aggs = [_mean(c, mean_decimals).alias(f"{c}_mean") for c in mean_cols]
    if medians == "exact":
        aggs += [F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)").alias(f"{c}_median") for c in median_cols]
    elif medians == "sketch":
        aggs += [F.percentile_approx(F.col(c), 0.5, accuracy).alias(f"{c}_median") for c in median_cols]
    aggs += [F.avg(F.col(c)).alias(f"{c}_mean") for c in raw_mean_cols]
    if medians == "measured" and median_cols:
        # the groups' rows are counted with their means, which are stored for that
        stats = materialize(src.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_rows")))
        largest = stats.agg(F.max("_rows")).first()[0] or 0
        stats, medians = stats.drop("_rows"), "sorted" if largest <= GROUP_ROWS else "exact_spread"
    else:
        stats = src.groupBy(*keys).agg(*aggs) if aggs else src.select(*keys).distinct()
    if medians not in ("exact_spread", "select", "sorted") or not median_cols:
        return stats
    if medians == "select":
        # rows without any value are in no median; left in, they need no other column than the open ones
        absent_too = stored and set(median_cols) <= set(presence)
        found = select_quantiles(df if absent_too else src, median_cols, [0.5], keys, stored=stored)
        kinds = [f"`__{k}` {src.schema[k].dataType.simpleString()}" for k in keys] + [f"`{c}_median` double" for c in median_cols]
        wide = F.broadcast(src.sparkSession.createDataFrame([(*key, *(own[c][0] for c in median_cols)) for key, own in found.items()], ", ".join(kinds)))
        return _with_medians(stats, wide, keys, mean_cols, median_cols)
    if medians == "sorted":
        wide = sorted_medians(src, keys, median_cols)
        wide = wide.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"{c}_median") for c in median_cols])
        return _with_medians(stats, wide, keys, mean_cols, median_cols)
    # Exact medians from value counts, pivoted to columns.
    long = (src.select(*keys, *[F.col(c).cast("double").alias(c) for c in median_cols])
               .unpivot(list(keys), list(median_cols), "column_name", "x"))
    med = exact_quantiles(long, [*keys, "column_name"], "x", [0.5])
    wide = (med.groupBy(*keys).pivot("column_name", list(median_cols)).agg(F.first(F.col("q")[0]))
               .select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"{c}_median") for c in median_cols]))
    return _with_medians(stats, wide, keys, mean_cols, median_cols)


def _with_medians(stats: DataFrame, wide: DataFrame, keys: Sequence[str], mean_cols: Sequence[str], median_cols: Sequence[str]) -> DataFrame:
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    names = [*stats.columns[:len(keys) + len(mean_cols)], *[f"{c}_median" for c in median_cols], *stats.columns[len(keys) + len(mean_cols):]]
    return stats.join(wide, same, "left").select(*names)


def group_modes(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                tokens: Iterable[str] | None = AUDIT_TOKENS, suffix: str = "_mode") -> DataFrame:
    """keys + ``{c}{suffix}``: most frequent non-missing value per group.

    Ties go to the largest value. All columns are handled by one unpivot and
    two aggregations (value counts, then a conditional ``max_by`` per column),
    instead of one count/max_by/outer-join chain per column.
    """
    cols = list(cols)
    long = (df.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot(list(keys), cols, "column_name", "value"))
    present = F.col("value").isNotNull() if tokens is None else ~is_missing("value", tokens, "string")
    counts = long.filter(present).groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    aggs = []
    for c in cols:
        hit = F.col("column_name") == c
        aggs.append(F.max_by(F.when(hit, F.col("value")), F.when(hit, F.struct("cnt", "value"))).alias(f"{c}{suffix}"))
    return counts.groupBy(*keys).agg(*aggs)


def global_stats(df: DataFrame, spec: Roles = WEATHER, default_median: float = 0.0,
                 default_mode: str = "N", stored: bool = False) -> dict:
    """Whole-frame medians, rounded discrete means and direction modes.

    Returns a small dict of scalars (one per column), like a fitted model;
    empty columns fall back to the defaults. ``stored`` as in :func:`group_stats`.
    """
    num = [c for c in spec.numeric if c not in spec.discrete]
    row = df.agg(*[F.round(F.avg(F.col(c))).cast("int").alias(c) for c in spec.discrete]).first().asDict()
    row.update({c: q[0] for c, q in select_quantiles(df, num, [0.5], stored=stored).get((), {}).items()})
    modes = group_modes(df.withColumn("__all", F.lit(1)), ["__all"], list(spec.directions), tokens=None).first()
    out = {c: (row.get(c) if row.get(c) is not None else default_median) for c in num}
    out.update({c: row[c] for c in spec.discrete if row[c] is not None})
    for c in spec.directions:
        v = modes[f"{c}_mode"] if modes is not None else None
        out[c] = v if v is not None else default_mode
    return out
