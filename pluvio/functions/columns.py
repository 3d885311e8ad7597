"""Row-level column builders: calendar keys, row means, long-form helpers."""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DIRECTIONS


def calendar_keys(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Adds ``Month`` (int) and ``DayMonth`` (``ddMM`` text)."""
    return df.withColumns({
        "Month": F.month(date_col),
        # as date_format(…, "ddMM"), which builds a zoned date-time for every row
        "DayMonth": F.concat(*[F.lpad(part(date_col).cast("string"), 2, "0") for part in (F.dayofmonth, F.month)]),
    })


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the given columns; null when any input is null."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total / float(len(cols))


def row_means(df: DataFrame, spec: dict[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({out: row_mean(ins) for out, ins in spec.items()})


def long_form(df: DataFrame, ids: Sequence[str], values: dict[str, Column],
              name: str = "column_name", value: str = "value") -> DataFrame:
    """Unpivot computed columns into (ids..., name, value) rows in one pass."""
    computed = df.select(*ids, *[v.alias(k) for k, v in values.items()])
    return computed.unpivot(list(ids), list(values), name, value)


def cyclic_month(c: str = "Month") -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * (F.col(c) - 1) / 12.0
    return {"Month_sin": F.sin(angle), "Month_cos": F.cos(angle)}


def direction_angle(c) -> Column:
    """Compass point -> degrees clockwise from north (null when unknown)."""
    col = F.col(c) if isinstance(c, str) else c
    idx = F.array_position(F.array(*[F.lit(d) for d in DIRECTIONS]), col)
    return F.when(idx > 0, (idx - 1) * 22.5)


def unit_vector(c) -> tuple[Column, Column]:
    """(ux, uy) = (sin θ, cos θ) for a compass point; null when unknown."""
    rad = F.radians(direction_angle(c))
    return F.sin(rad), F.cos(rad)


def vector_direction(ux: Column, uy: Column, eps: float = 1e-9) -> Column:
    """Nearest compass point of a vector; null when its length is below eps."""
    # Degrees are rounded to 6 places first so that exact sector boundaries
    # (e.g. the bisector of two points) resolve the same way in any engine.
    deg = F.round(F.pmod(F.degrees(F.atan2(ux, uy)), F.lit(360.0)), 6)
    idx = F.pmod(F.round(deg / 22.5).cast("int"), F.lit(16))
    points = F.array(*[F.lit(d) for d in DIRECTIONS])
    return F.when(F.sqrt(ux * ux + uy * uy) >= eps, F.element_at(points, idx + 1))


def first_non_null(cols: Iterable[Column]) -> Column:
    return F.coalesce(*cols)
