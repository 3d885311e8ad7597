"""Daily-series imputation by neighbours, and circular wind directions.

These follow the reference's stated design (its code does not contain
them): numbers are imputed from the previous/next day of the same
location, directions through unit vectors, with monthly fallbacks.

Skew: the neighbour window is partitioned by location, but it runs on the
*daily* series (rows are first averaged per location and day, map-side
combined), so a window partition holds at most one row per calendar day
whatever the raw volume of a hot location.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WEATHER, Roles
from ..functions.columns import unit_vector, vector_direction
from . import impute

EPS = 1e-9


def impute_month(df: DataFrame, fit: DataFrame, spec: Roles = WEATHER) -> DataFrame:
    """Numeric gaps filled by month (mean for normal, median otherwise)."""
    return impute.impute_by(df, fit, ["Month"], spec, broadcast_stats=True)


def daily_series(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER,
                 decimals: int | None = None) -> DataFrame:
    """One row per (location, date): numeric columns averaged (rows with a date only)."""
    cols = list(cols or spec.numeric)
    m = lambda c: F.round(F.avg(c), decimals) if decimals is not None else F.avg(c)
    return (df.filter(F.col(spec.date).isNotNull())
              .groupBy(spec.location, spec.date)
              .agg(*[m(c).alias(c) for c in cols])
              .withColumn("Month", F.month(spec.date)))


def _neighbour_fill(c: str, w) -> Column:
    prev, nxt = F.lag(c).over(w), F.lead(c).over(w)
    both = (prev + nxt) / 2
    return F.when(F.col(c).isNull(), F.coalesce(both, prev, nxt)).otherwise(F.col(c))


def neighbour_impute(daily: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """R2: a missing day value becomes the mean of the previous and next day's values
    at the same location (or whichever of the two exists)."""
    cols = list(cols or spec.numeric)
    w = Window.partitionBy(spec.location).orderBy(spec.date)
    return daily.select(*[_neighbour_fill(c, w).alias(c) if c in cols else F.col(c) for c in daily.columns])


def daily_roles(spec: Roles = WEATHER) -> Roles:
    """Roles on the daily series: averaged clouds are continuous, not discrete."""
    return spec.with_(discrete=())


def impute_location_month(daily: DataFrame, fit: DataFrame | None = None, spec: Roles = WEATHER) -> DataFrame:
    """Remaining gaps filled by (location, month) mean/median of the series."""
    roles = daily_roles(spec)
    return impute.impute_by(daily, fit if fit is not None else daily, [spec.location, "Month"], roles)


# ---------------------------------------------------------------------------
# Circular directions
# ---------------------------------------------------------------------------

def direction_vectors(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER,
                      decimals: int | None = None) -> DataFrame:
    """Adds ``{c}_ux`` = sin θ and ``{c}_uy`` = cos θ (θ clockwise from north)."""
    out = {}
    for c in cols or spec.directions:
        ux, uy = unit_vector(c)
        out[f"{c}_ux"] = F.round(ux, decimals) if decimals is not None else ux
        out[f"{c}_uy"] = F.round(uy, decimals) if decimals is not None else uy
    return df.withColumns(out)


def daily_directions(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """One row per (location, date): summed unit vectors of each direction column."""
    cols = list(cols or spec.directions)
    aggs = []
    for c in cols:
        ux, uy = unit_vector(c)
        aggs += [F.sum(ux).alias(f"{c}_sx"), F.sum(uy).alias(f"{c}_sy")]
    return (df.filter(F.col(spec.date).isNotNull()).groupBy(spec.location, spec.date).agg(*aggs)
              .withColumn("Month", F.month(spec.date)))


def circular_impute(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """Daily direction = direction of the summed unit vectors; a day without one
    takes the direction of the previous + next day's vectors (null if they cancel)."""
    cols = list(cols or spec.directions)
    d = daily_directions(df, cols, spec)
    w = Window.partitionBy(spec.location).orderBy(spec.date)
    out = [F.col(spec.location), F.col(spec.date), F.col("Month")]
    for c in cols:
        sx, sy = F.col(f"{c}_sx"), F.col(f"{c}_sy")
        own = vector_direction(sx, sy, EPS)
        px, py = F.lag(sx).over(w), F.lag(sy).over(w)
        nx, ny = F.lead(sx).over(w), F.lead(sy).over(w)
        # Neighbours contribute their unit direction (normalised sums); a
        # neighbour whose vectors cancel (length < EPS) contributes nothing.
        pl = F.sqrt(px * px + py * py)
        nl = F.sqrt(nx * nx + ny * ny)
        pl = F.when(pl >= EPS, pl)
        nl = F.when(nl >= EPS, nl)
        ux = F.coalesce(F.try_divide(px, pl), F.lit(0.0)) + F.coalesce(F.try_divide(nx, nl), F.lit(0.0))
        uy = F.coalesce(F.try_divide(py, pl), F.lit(0.0)) + F.coalesce(F.try_divide(ny, nl), F.lit(0.0))
        out.append(F.coalesce(own, vector_direction(ux, uy, EPS)).alias(c))
    return d.select(*out)


def circular_month_fallback(daily: DataFrame, raw: DataFrame, cols: Sequence[str] | None = None,
                            spec: Roles = WEATHER) -> DataFrame:
    """Remaining null directions → monthly circular mean of the raw rows
    (12 groups, broadcast); near-zero mean vectors give null."""
    cols = list(cols or spec.directions)
    aggs = []
    for c in cols:
        ux, uy = unit_vector(c)
        aggs.append(vector_direction(F.sum(ux), F.sum(uy), EPS).alias(f"{c}_month"))
    monthly = (raw.filter(F.col(spec.date).isNotNull()).withColumn("Month", F.month(spec.date))
                  .groupBy("Month").agg(*aggs))
    joined = daily.join(F.broadcast(monthly), ["Month"], "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"{c}_month")).alias(c) if c in cols else F.col(c)
                           for c in daily.columns])
