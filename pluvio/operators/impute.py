"""Tiered imputation: group statistics joined back to the rows.

Statistics are fitted on one frame (``fit``) and applied to another; every
apply step is one left join (or a broadcast join when the statistics are
keyed by a label-sized domain) plus one projection.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AUDIT_TOKENS, WEATHER, Roles
from ..functions.predicates import is_missing, threshold_flag
from .groupstats import group_modes, group_stats
from ..session import materialize
from .joins import join_statistics, measured_broadcast

FLAG = "RainToday_inferred"


def _discrete_fill(c: str, mean_col: str) -> Column:
    return F.round(F.coalesce(F.col(mean_col), F.lit(0.0))).cast("int")


def tier1_stats(fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER) -> DataFrame:
    """Group means (normal), medians (continuous non-normal), raw means (discrete)."""
    return group_stats(fit, keys, mean_cols=spec.normal, median_cols=spec.continuous,
                       raw_mean_cols=spec.discrete, presence_cols=spec.numeric,
                       medians=spec.medians, mean_decimals=spec.mean_decimals)


def wide_stats(fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER) -> DataFrame:
    """Mean and median of every continuous column, mean of the discrete ones (G1, G2 in full).

    The tiers read one of the two per column and take :func:`tier1_stats`.
    """
    both = [c for c in spec.numeric if c not in spec.discrete]
    return group_stats(fit, keys, mean_cols=both, median_cols=both, raw_mean_cols=spec.discrete, presence_cols=spec.numeric,
                       medians=spec.medians, mean_decimals=spec.mean_decimals)


def tier1_modes(fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER) -> DataFrame:
    return group_modes(fit, keys, spec.directions, tokens=AUDIT_TOKENS)


def _numeric_fill(df: DataFrame, spec: Roles) -> list[Column]:
    out = []
    for c in df.columns:
        if c in spec.normal:
            out.append(F.when(F.col(c).isNull(), F.col(f"{c}_mean")).otherwise(F.col(c)).alias(c))
        elif c in spec.discrete:
            out.append(F.when(F.col(c).isNull(), _discrete_fill(c, f"{c}_mean")).otherwise(F.col(c)).alias(c))
        elif c in spec.continuous:
            out.append(F.when(F.col(c).isNull(), F.col(f"{c}_median")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return out


def impute_group_numeric(df: DataFrame, fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER) -> DataFrame:
    """Tier-1 numeric fill by group (I1 with 3 keys, I2 with 2 keys)."""
    stats = tier1_stats(fit, keys, spec)
    return join_statistics(df, [stats], keys).select(*_numeric_fill(df, spec))


def _wind_fill(df: DataFrame, spec: Roles, suffix: str = "_mode") -> list[Column]:
    return [F.when(is_missing(c, AUDIT_TOKENS, "string"), F.col(f"{c}{suffix}")).otherwise(F.col(c)).alias(c)
            if c in spec.directions else F.col(c) for c in df.columns]


def impute_group_mode(df: DataFrame, fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER) -> DataFrame:
    """Wind directions: missing → group mode (I5 with 3 keys, I6 with 2 keys)."""
    modes = tier1_modes(fit, keys, spec)
    return join_statistics(df, [modes], keys).select(*_wind_fill(df, spec))


def raintoday_modes(fit: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """Mode of upper-cased, non-missing RainToday per label (G7): ≤ |labels| rows."""
    up = fit.withColumn(spec.rain_today, F.upper(F.trim(spec.rain_today)))
    return group_modes(up, [spec.label], [spec.rain_today], tokens=AUDIT_TOKENS)


def _upper_rain(df: DataFrame, spec: Roles) -> DataFrame:
    return df.withColumn(spec.rain_today, F.upper(F.trim(spec.rain_today)))


def impute_raintoday_train(df: DataFrame, fit: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """RainToday upper-cased; missing → mode of its label in ``fit``."""
    r = spec.rain_today
    modes = raintoday_modes(fit, spec)  # one row per label value
    up = _upper_rain(df, spec)
    joined = up.join(measured_broadcast(modes), [spec.label], "left")
    return joined.select(*[F.when(is_missing(r, AUDIT_TOKENS, "string"), F.col(f"{r}_mode")).otherwise(F.col(r)).alias(r)
                           if c == r else F.col(c) for c in df.columns])


def impute_raintoday_test(df: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """RainToday upper-cased; missing → Yes when rain amount > 0 else No (I4).

    The reference adds a DayMonth-mode fallback behind this rule, but the
    rule never yields null, so that fallback (and its shuffle) is omitted.
    """
    r = spec.rain_today
    up = _upper_rain(df, spec)
    flag = threshold_flag(spec.rain_amount, 0.0)
    return up.select(*[F.when(is_missing(r, AUDIT_TOKENS, "string"), flag).otherwise(F.col(r)).alias(r)
                       if c == r else F.col(c) for c in df.columns])


def impute_tier1(df: DataFrame, fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER,
                 train: bool = True) -> DataFrame:
    """Numeric, RainToday and wind tier 1 in one apply step.

    Numeric statistics and wind modes are grouped on the same keys, so the
    rows meet both statistic tables in one pass: broadcast where these measure small, else on one shuffle.
    """
    stats = tier1_stats(fit, keys, spec)
    modes = tier1_modes(fit, keys, spec)
    joined = join_statistics(df, [stats, modes], keys)
    num = joined.select(*_numeric_fill(df, spec), *[f"{c}_mode" for c in spec.directions])
    if train:
        r = spec.rain_today
        rmodes = raintoday_modes(fit, spec)
        num = _upper_rain(num, spec).join(measured_broadcast(rmodes), [spec.label], "left")
        num = num.withColumn(r, F.when(is_missing(r, AUDIT_TOKENS, "string"), F.col(f"{r}_mode")).otherwise(F.col(r)))
    else:
        num = impute_raintoday_test(num, spec)
    return num.select(*_wind_fill(df, spec))


def tier2_stats(fit: DataFrame, key: str, spec: Roles = WEATHER, stored: bool = False) -> DataFrame:
    """Per-key medians (normal and continuous) and raw discrete means (G3/G4); ``stored`` as in ``select_quantiles``."""
    return group_stats(fit, [key], median_cols=[*spec.normal, *spec.continuous], raw_mean_cols=spec.discrete,
                       presence_cols=spec.numeric, medians="select", stored=stored)


def tier2_modes(fit: DataFrame, key: str, spec: Roles = WEATHER) -> DataFrame:
    return group_modes(fit, [key], spec.directions, tokens=None, suffix="_mode")


def impute_secondary(df: DataFrame, fit: DataFrame, key: str | None = None, spec: Roles = WEATHER,
                     infer_flag: bool = False, stored: bool = False) -> DataFrame:
    """Tier 2: residual nulls by label (I7) or by the inferred rain flag (I8).

    The statistics have one row per key value (labels or Yes/No) and are broadcast:
    their medians by selection raise an error beyond 1,000 groups, whatever key the roles name. ``stored`` says that ``fit`` reads files.
    """
    if infer_flag:
        key = FLAG
        flag = threshold_flag(spec.rain_amount, 0.0)
        fit, rows = fit.withColumn(key, flag), df.withColumn(key, flag)
    else:
        key = key or spec.label
        rows = df
    # stored, as the result may be read more than once
    stats = materialize(tier2_stats(fit, key, spec, stored))
    modes = materialize(tier2_modes(fit, key, spec))
    joined = rows.join(F.broadcast(stats), [key], "left").join(F.broadcast(modes), [key], "left")
    out = []
    for c in df.columns:
        if c in spec.normal or c in spec.continuous:
            out.append(F.when(F.col(c).isNull(), F.col(f"{c}_median")).otherwise(F.col(c)).alias(c))
        elif c in spec.discrete:
            out.append(F.when(F.col(c).isNull(), _discrete_fill(c, f"{c}_mean")).otherwise(F.col(c)).alias(c))
        elif c in spec.directions:
            out.append(F.when(F.col(c).isNull(), F.col(f"{c}_mode")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def impute_global(df: DataFrame, stats: dict, spec: Roles = WEATHER) -> DataFrame:
    """Last-resort fill with whole-frame statistics (I9), via ``fillna``."""
    fill = {c: v for c, v in stats.items() if c in df.columns and v is not None}
    return df.fillna(fill)


def impute_by(df: DataFrame, fit: DataFrame, keys: Sequence[str], spec: Roles = WEATHER,
              normal_how: str = "mean", broadcast_stats: bool = False) -> DataFrame:
    """Numeric fill by any grouping: mean for normal columns (or median), median otherwise.

    Used for the month and location+month fallbacks (R1, R3).
    """
    normal_mean = normal_how == "mean"
    stats = group_stats(fit, keys, mean_cols=spec.normal if normal_mean else (),
                        median_cols=[*([] if normal_mean else spec.normal), *spec.continuous],
                        raw_mean_cols=spec.discrete, presence_cols=spec.numeric,
                        medians="select" if broadcast_stats else spec.medians, mean_decimals=spec.mean_decimals)
    # broadcast_stats only for few groups (e.g. 12 months): medians by selection raise an error beyond 1,000.
    joined = df.join(F.broadcast(stats) if broadcast_stats else stats, list(keys), "left")
    out = []
    for c in df.columns:
        if c in spec.normal:
            src = f"{c}_mean" if normal_mean else f"{c}_median"
            out.append(F.coalesce(F.col(c), F.col(src)).alias(c))
        elif c in spec.discrete:
            out.append(F.when(F.col(c).isNull(), F.round(F.col(f"{c}_mean")).cast("int")).otherwise(F.col(c)).alias(c))
        elif c in spec.continuous:
            out.append(F.coalesce(F.col(c), F.col(f"{c}_median")).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)
