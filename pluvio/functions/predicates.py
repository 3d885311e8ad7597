"""Column-building predicates and normalisers (pure JVM expressions, no UDFs)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AUDIT_TOKENS, WIND_TOKENS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


NUMERIC_TYPES = ("double", "float")
EXACT_TYPES = ("tinyint", "smallint", "int", "bigint", "boolean", "date", "timestamp", "timestamp_ntz")


def is_missing(c, tokens: Iterable[str] = AUDIT_TOKENS, dtype: str | None = None) -> Column:
    """SQL null, or a missing token after string cast + trim + lower-case.

    With the column's ``dtype`` known, the string cast is skipped where its
    text could never equal a token: floating values only match via NaN
    (text ``nan``), integers, booleans and dates never do.
    """
    col = _c(c)
    toks = [t.lower() for t in tokens]
    if dtype is not None and _numeric_text(toks):
        dtype = None  # a token could equal a number's text: compare text
    if dtype in NUMERIC_TYPES:
        return (col.isNull() | F.isnan(col)) if "nan" in toks else col.isNull()
    if dtype in EXACT_TYPES:
        return col.isNull()
    return col.isNull() | F.lower(F.trim(col.cast("string"))).isin(*toks)


def _numeric_text(tokens: Iterable[str]) -> bool:
    """True when some token (other than nan) reads as a number or boolean."""
    for t in tokens:
        if t in ("true", "false"):
            return True
        try:
            float(t)
        except ValueError:
            continue
        if t.strip().lower() != "nan":
            return True
    return False


def missing_in(df: DataFrame, c: str, tokens: Iterable[str] = AUDIT_TOKENS) -> Column:
    """:func:`is_missing` specialised with the column's type in ``df``."""
    return is_missing(c, tokens, dict(df.dtypes).get(c))


def is_null(c) -> Column:
    """Plain null test (numeric columns)."""
    return _c(c).isNull()


def is_token(c, tokens: Iterable[str], dtype: str | None = None) -> Column:
    """Non-null text equal to one of the tokens after trim + lower-case.

    With ``dtype`` known and no token readable as a number, non-text columns
    cannot match and the per-value string cast is skipped.
    """
    toks = [t.lower() for t in tokens]
    if dtype is not None and dtype != "string" and not _numeric_text(toks):
        if dtype in NUMERIC_TYPES and "nan" in toks:
            return F.isnan(_c(c))
        return F.lit(False)
    return F.lower(F.trim(_c(c).cast("string"))).isin(*toks)


def all_present(cols: Iterable[str], tokens: Iterable[str] = AUDIT_TOKENS,
                dtypes: dict[str, str] | None = None) -> Column:
    dtypes = dtypes or {}
    return reduce(lambda a, b: a & b, [~is_missing(c, tokens, dtypes.get(c)) for c in cols])


def complete_rows(df: DataFrame, cols: Iterable[str], tokens: Iterable[str] = AUDIT_TOKENS) -> DataFrame:
    """Rows that have every one of ``cols`` (P14): neither null nor a missing token."""
    return df.filter(all_present(list(cols), tokens, dict(df.dtypes)))


def any_present(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])


def number(c: str) -> Column:
    """The column as a double; text that is no number and NaN are missing."""
    x = F.col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One projection casting the listed columns; unparsable text becomes null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def normalize_tokens(c, tokens: Iterable[str] = WIND_TOKENS) -> Column:
    """Upper-case + trim; values in the token set become null."""
    up = F.upper(F.trim(_c(c)))
    return F.when(up.isin(*[t.upper() for t in tokens]), F.lit(None).cast("string")).otherwise(up)


def canonical_binary(c, yes: str = "Yes", no: str = "No") -> Column:
    """Any casing of yes/no becomes ``Yes``/``No``; other values unchanged."""
    c = _c(c)
    low = F.lower(F.trim(c))
    return F.when(low == yes.lower(), F.lit(yes)).when(low == no.lower(), F.lit(no)).otherwise(c)


ISO_DATE = "yyyy-MM-dd"


def parse_date(c, fmt: str = ISO_DATE, is_text: bool = True) -> Column:
    """Tolerant date parse: unparsable text (or invalid casts) give null."""
    c = _c(c)
    if not is_text:
        return c.try_cast("date")
    if fmt != ISO_DATE:
        return F.try_to_date(c, fmt)
    # the plain form by a cast, which builds no zoned date-time for every row
    return F.when(c.rlike("\\A[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}\\z"), c.try_cast("date")).otherwise(F.try_to_date(c, fmt))


def threshold_flag(c, threshold: float = 0.0, yes: str = "Yes", no: str = "No") -> Column:
    """``yes`` when value > threshold, else ``no`` (null included)."""
    return F.when(_c(c) > threshold, F.lit(yes)).otherwise(F.lit(no))


def encode_binary(c, positive: str = "Yes") -> Column:
    return F.when(_c(c) == positive, F.lit(1.0)).otherwise(F.lit(0.0))


def typed_null(dtype) -> Column:
    return F.lit(None).cast(dtype)
