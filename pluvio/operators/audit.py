"""Data-quality audit: every family is one aggregate pass plus an unpivot.

The reference issues one Spark job per column (and per pair of columns);
here each family is a single wide aggregate, and the full quality report
is one scan + one shuffle (the duplicate grouping), with every counter
weighted by the group multiplicity so no second scan is needed.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import AUDIT_TOKENS, RESIDUAL_TOKENS, WEATHER, Roles
from ..functions.columns import long_form
from ..functions.predicates import all_present, is_missing, is_token, parse_date

PCT_DECIMALS = 6


def pct(num: Column, den: Column) -> Column:
    """Percentage rounded to PCT_DECIMALS; null when the denominator is 0."""
    return F.round(F.try_divide(num * 100.0, den), PCT_DECIMALS)


def _cols(df: DataFrame, cols: Sequence[str] | None, spec: Roles) -> list[str]:
    if cols is not None:
        return list(cols)
    return [c for c in spec.columns if c in df.columns]


def out_of_range(c: str, lo: float, hi: float) -> Column:
    """Non-null, non-NaN value outside [lo, hi] (NaN counts as missing)."""
    v = F.col(c).try_cast("double")
    return v.isNotNull() & ~F.isnan(v) & ((v < lo) | (v > hi))


def invalid_date(c: str, fmt: str, is_text: bool = True) -> Column:
    """Text that is present but does not parse; for date columns, null."""
    if is_text:
        return F.col(c).isNotNull() & parse_date(c, fmt).isNull()
    return F.col(c).isNull()


# ---------------------------------------------------------------------------
# Table profile
# ---------------------------------------------------------------------------

def table_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, type, nullable, n_rows, n_cols): schema plus one count job."""
    fields = df.schema.fields
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"))
                    for i, f in enumerate(fields)])
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.inline(arr), "n_rows", F.lit(len(fields)).alias("n_cols")))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """``n`` rows: the first by ``order`` (each task keeps its own first n), or any where none is named."""
    return (df.orderBy(*order) if order else df).limit(n)


# ---------------------------------------------------------------------------
# Q1 / Q2: missing values and completeness
# ---------------------------------------------------------------------------

def missing_profile(df: DataFrame, cols: Sequence[str] | None = None,
                    tokens: Iterable[str] = AUDIT_TOKENS, spec: Roles = WEATHER) -> DataFrame:
    """(column_name, n_missing, pct) for every column, most missing first."""
    cols = _cols(df, cols, spec)
    tokens = tuple(tokens)
    dt = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(is_missing(c, tokens, dt[c])).alias(c) for c in cols])
    long = wide.unpivot(["n_rows"], cols, "column_name", "n_missing")
    return (long.select("column_name", "n_missing", pct(F.col("n_missing"), F.col("n_rows")).alias("pct"))
                .orderBy(F.desc("n_missing"), "column_name"))


def completeness(df: DataFrame, cols: Sequence[str] | None = None,
                 tokens: Iterable[str] = AUDIT_TOKENS, spec: Roles = WEATHER) -> DataFrame:
    """(n_rows, n_complete, n_incomplete, pct_complete)."""
    cols = _cols(df, cols, spec)
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(all_present(cols, tuple(tokens), dict(df.dtypes))).alias("n_complete"))
    return agg.select("n_rows", "n_complete", (F.col("n_rows") - F.col("n_complete")).alias("n_incomplete"),
                      pct(F.col("n_complete"), F.col("n_rows")).alias("pct_complete"))


# ---------------------------------------------------------------------------
# Q3 / Q4: domain checks, Q5: ranges
# ---------------------------------------------------------------------------

def domain_violations(df: DataFrame, domains: dict[str, Sequence[str]]) -> DataFrame:
    """(column_name, value, n_rows): non-null values outside each column's domain.

    One scan: each row is unpivoted to (column, value, valid) and only invalid
    values reach the (map-side combined) count.
    """
    cols = list(domains)
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], cols, "column_name", "value"))
    allowed = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(v) for v in domains[c]]))])
    bad = long.filter(F.col("value").isNotNull()
                      & ~F.array_contains(F.element_at(allowed, F.col("column_name")), F.col("value")))
    return bad.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def range_violations(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None,
                     spec: Roles = WEATHER) -> DataFrame:
    """(column_name, lo, hi, n_out) for every checked column, in one pass."""
    ranges = ranges or spec.ranges
    cols = [c for c in ranges if c in df.columns]
    wide = df.agg(*[F.count_if(out_of_range(c, *ranges[c])).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "n_out")
    bounds = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(F.lit(float(ranges[c][0])),
                                                                        F.lit(float(ranges[c][1]))))])
    b = F.element_at(bounds, F.col("column_name"))
    return long.select("column_name", b[0].alias("lo"), b[1].alias("hi"), "n_out")


# ---------------------------------------------------------------------------
# Q6 / Q7: dates
# ---------------------------------------------------------------------------

def invalid_dates(df: DataFrame, col: str = "Date", fmt: str = "yyyy-MM-dd",
                  extra_cols: Sequence[str] = ("Location",), limit: int | None = 20) -> DataFrame:
    """Rows whose date does not parse, projected to the date and extra columns.

    ``limit`` keeps the first examples in (extra..., date) order, as the
    reference shows at most 20; ``None`` returns all offending rows.
    """
    is_text = dict(df.dtypes)[col] == "string"
    bad = df.filter(invalid_date(col, fmt, is_text)).select(col, *extra_cols)
    if limit is None:
        return bad
    order = [F.col(c).asc_nulls_first() for c in (*extra_cols, col)]
    return bad.orderBy(*order).limit(limit)


def invalid_date_report(df: DataFrame, col: str = "Date", fmt: str = "yyyy-MM-dd",
                        extra_cols: Sequence[str] = ("Location",), limit: int = 20) -> DataFrame:
    """The examples of :func:`invalid_dates` with ``n_invalid``, how many rows there are in all.

    Rows that agree in the date and the extra columns are counted on the map side;
    the total and the examples read that one small shuffle. No row if no date is bad.
    """
    is_text = dict(df.dtypes)[col] == "string"
    cols = [col, *extra_cols]
    counts = df.filter(invalid_date(col, fmt, is_text)).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col(c).asc_nulls_first() for c in (*extra_cols, col)]
    first = counts.orderBy(*order).limit(limit).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("_n", F.lit(limit)))))
    total = counts.agg(F.sum("_n").alias("n_invalid")).scalar()
    return first.orderBy(*order).limit(limit).select(*cols, total.alias("n_invalid"))


def date_span(df: DataFrame, col: str = "Date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """(first_date, last_date, n_invalid) over the parsed dates."""
    is_text = dict(df.dtypes)[col] == "string"
    d = parse_date(col, fmt, is_text)
    return df.agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"),
                  F.count_if(invalid_date(col, fmt, is_text)).alias("n_invalid"))


# ---------------------------------------------------------------------------
# Q8 / Q9: boolean-like columns
# ---------------------------------------------------------------------------

def boolean_columns(df: DataFrame, named: Sequence[str] = ()) -> list[str]:
    """BooleanType fields plus explicitly named text columns."""
    typed = [f.name for f in df.schema.fields if f.dataType.typeName() == "boolean"]
    return typed + [c for c in named if c in df.columns and c not in typed]


def boolean_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n): value frequencies (null is a value) per column."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


TRUE_TEXT = ("true", "yes", "1")
FALSE_TEXT = ("false", "no", "0")


def boolean_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, n_non_null, pct_true, pct_false, pct_other) over non-null rows."""
    aggs = []
    for c in cols:
        text = F.lower(F.col(c).cast("string"))
        aggs += [F.count(c).alias(f"{c}__n"),
                 F.count_if(text.isin(*TRUE_TEXT)).alias(f"{c}__t"),
                 F.count_if(text.isin(*FALSE_TEXT)).alias(f"{c}__f")]
    wide = df.agg(*aggs)
    packed = wide.select(*[F.struct(F.col(f"{c}__n").alias("n"), F.col(f"{c}__t").alias("t"),
                                    F.col(f"{c}__f").alias("f")).alias(c) for c in cols])
    long = packed.unpivot([], list(cols), "column_name", "s")
    n, t, f = F.col("s.n"), F.col("s.t"), F.col("s.f")
    return long.select("column_name", n.alias("n_non_null"), pct(t, n).alias("pct_true"),
                       pct(f, n).alias("pct_false"), pct(n - t - f, n).alias("pct_other"))


# ---------------------------------------------------------------------------
# Q10 / Q11 / Q12: duplicates and score
# ---------------------------------------------------------------------------

#: Flags that one bit mask holds.
MASK_BITS = 62


def _masks(flags: Sequence[Column]) -> list[Column]:
    """Bit masks of boolean columns (null is false), MASK_BITS of them in each."""
    bits = [F.when(f, F.lit(1 << i % MASK_BITS).cast("long")).otherwise(F.lit(0).cast("long")) for i, f in enumerate(flags)]
    return [sum(bits[k + 1:k + MASK_BITS], bits[k]) for k in range(0, len(bits), MASK_BITS)]


def _digest(cols: Sequence[str]) -> list[Column]:
    """128 bits that stand for a row's typed values: two 64-bit hashes of all columns with different seeds.

    Hashes skip nulls, so the places of the nulls are hashed along. Two of 10^12
    different rows agree with a probability of about 10^-15.
    """
    parts = [*_masks([F.isnull(c) for c in cols]), *(F.col(c) for c in cols)]
    return [F.xxhash64(*parts).alias("__h1"), F.xxhash64(F.lit(1), *parts).alias("__h2")]


def _grouped(df: DataFrame, cols: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    """One row per different row of ``cols``: ``keep`` (functions of the row) and __n, its copies.

    Rows are grouped on their digest, so sixteen bytes and ``keep`` are shuffled
    of each, not its columns.
    """
    keyed = df.select(*_digest(cols), *keep)
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("__n")).drop("__h1", "__h2")


def duplicate_summary(df: DataFrame, cols: Sequence[str] | None = None, spec: Roles = WEATHER) -> DataFrame:
    """(n_rows, n_distinct, n_duplicates, pct_duplicates): one shuffle."""
    cols = _cols(df, cols, spec)
    agg = _grouped(df, cols).agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    dup = F.col("n_rows") - F.col("n_distinct")
    return agg.select("n_rows", "n_distinct", dup.alias("n_duplicates"),
                      pct(dup, F.col("n_rows")).alias("pct_duplicates"))


def top_duplicates(df: DataFrame, k: int = 5, cols: Sequence[str] | None = None,
                   show: Sequence[str] = ("Date", "Location", "MinTemp", "MaxTemp", "Rainfall",
                                          "RainToday", "RainTomorrow"),
                   spec: Roles = WEATHER) -> DataFrame:
    """The k most repeated rows: (n_copies, show...), ties by the shown values."""
    cols = _cols(df, cols, spec)
    g = _grouped(df, cols, [F.col(c) for c in show]).filter(F.col("__n") > 1)
    order = [F.desc("__n")] + [F.col(c).asc_nulls_first() for c in show]
    return g.orderBy(*order).limit(k).select(F.col("__n").alias("n_copies"), *show)


def quality_score(df: DataFrame, cols: Sequence[str] | None = None,
                  tokens: Iterable[str] = AUDIT_TOKENS, spec: Roles = WEATHER) -> DataFrame:
    """(pct_complete, pct_duplicates, score) with score = %complete × (1 − dup/total)."""
    cols = _cols(df, cols, spec)
    g = _grouped(df, cols, [all_present(cols, tuple(tokens), dict(df.dtypes)).alias("__complete")])
    agg = g.agg(F.sum("__n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                F.sum(F.when(F.col("__complete"), F.col("__n")).otherwise(0)).alias("n_complete"))
    return agg.select(*_score_cols())


def _score_cols() -> list[Column]:
    n, d, c = F.col("n_rows"), F.col("n_distinct"), F.col("n_complete")
    pc = F.try_divide(c * 100.0, n)
    score = pc * (1 - F.try_divide((n - d).cast("double"), n))
    return [F.round(pc, PCT_DECIMALS).alias("pct_complete"),
            pct(n - d, n).alias("pct_duplicates"),
            F.round(score, PCT_DECIMALS).alias("score")]


# ---------------------------------------------------------------------------
# Q13: the executive report in one scan + one shuffle
# ---------------------------------------------------------------------------

def audit_counters(df: DataFrame, spec: Roles = WEATHER, tokens: Iterable[str] = AUDIT_TOKENS,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """One-row frame with every audit counter.

    Rows are first grouped on a digest of all columns and a bit mask of what is
    wrong with them; all counters are then sums weighted by the group size, so
    duplicates, completeness, missing counts, range and date violations come
    from the same pass.
    """
    cols = _cols(df, cols, spec)
    tokens = tuple(tokens)
    dt = dict(df.dtypes)
    is_text = dt.get(spec.date) == "string"
    flags = {"n_complete": all_present(cols, tokens, dt),
             "n_invalid_dates": invalid_date(spec.date, spec.date_format, is_text)}
    flags |= {f"miss__{c}": is_missing(c, tokens, dt[c]) for c in cols}
    flags |= {f"range__{c}": out_of_range(c, *r) for c, r in spec.ranges.items() if c in cols}
    masks = _masks(list(flags.values()))
    g = _grouped(df, cols, [m.alias(f"__m{i}") for i, m in enumerate(masks)])
    n = F.col("__n")

    def wsum(i: int) -> Column:
        bit = F.col(f"__m{i // MASK_BITS}").bitwiseAND(F.lit(1 << i % MASK_BITS).cast("long"))
        return F.sum(F.when(bit != 0, n).otherwise(0))

    return g.agg(F.sum(n).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                 *[wsum(i).alias(name) for i, name in enumerate(flags)])


def quality_report(df: DataFrame, spec: Roles = WEATHER, tokens: Iterable[str] = AUDIT_TOKENS,
                   cols: Sequence[str] | None = None, worst: int = 15) -> DataFrame:
    """(metric, value, pct): score, incomplete rows, duplicates, bad dates,
    out-of-range cases and the ``worst`` columns by missing share."""
    cols = _cols(df, cols, spec)
    ranges = [c for c in spec.ranges if c in cols]
    cnt = audit_counters(df, spec, tokens, cols)
    n, d, c = F.col("n_rows"), F.col("n_distinct"), F.col("n_complete")
    score = F.try_divide(c * 100.0, n) * (1 - F.try_divide((n - d).cast("double"), n))
    out_range = sum((F.col(f"range__{x}") for x in ranges), F.lit(0))

    def row(metric, value, pct_col):
        return F.struct(metric.alias("metric"), value.cast("double").alias("value"), pct_col.cast("double").alias("pct"))

    head = [
        row(F.lit("quality_score"), F.round(score, PCT_DECIMALS), F.lit(None)),
        row(F.lit("incomplete_rows"), n - c, pct(n - c, n)),
        row(F.lit("duplicate_rows"), n - d, pct(n - d, n)),
        row(F.lit("invalid_dates"), F.col("n_invalid_dates"), pct(F.col("n_invalid_dates"), n)),
        row(F.lit("out_of_range"), out_range, pct(out_range, n)),
    ]
    # The worst columns are ranked inside the single counter row: sort
    # (-n_missing, name) ascending = most missing first, ties by name.
    miss = F.array(*[F.struct((-F.col(f"miss__{x}")).alias("k"), F.lit(x).alias("name"),
                              F.col(f"miss__{x}").alias("m")) for x in cols])
    worst_rows = F.transform(F.slice(F.sort_array(miss), 1, worst),
                             lambda e: row(F.concat(F.lit("missing:"), e["name"]), e["m"], pct(e["m"], n)))
    # One projection over the one-row counters: the grouping runs once.
    return cnt.select(F.inline(F.concat(F.array(*head), worst_rows)))


# ---------------------------------------------------------------------------
# Q14: null co-occurrence of the k worst columns (two aggregates)
# ---------------------------------------------------------------------------

def missing_cooccurrence(df: DataFrame, k: int = 5, cols: Sequence[str] | None = None,
                         tokens: Iterable[str] = AUDIT_TOKENS, spec: Roles = WEATHER) -> DataFrame:
    """(col_a, col_b, n_both, pct) for every pair of the k most-missing columns.

    Two aggregates over the table: the first counts missing values per column
    and names the k columns (ties by name); the second counts their pairs. One
    value per column reaches the driver; nothing is shuffled but partial sums.
    """
    cols = _cols(df, cols, spec)
    dt, tokens = dict(df.dtypes), tuple(tokens)
    missing = {c: is_missing(c, tokens, dt[c]) for c in cols}
    totals = df.agg(*[F.count_if(missing[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    worst = sorted(range(len(cols)), key=lambda i: (-totals[i], cols[i]))[:k]
    pairs = [(cols[i], cols[j]) for n, i in enumerate(worst) for j in worst[n + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, n_both long, pct double")
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(missing[a] & missing[b]).alias(f"p{n}") for n, (a, b) in enumerate(pairs)])
    counted = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"p{n}").alias("n_both"))
                        for n, (a, b) in enumerate(pairs)])
    return (wide.select("n_rows", F.inline(counted))
            .select("col_a", "col_b", "n_both", pct(F.col("n_both"), F.col("n_rows")).alias("pct")))


# ---------------------------------------------------------------------------
# Q15: residual nulls and tokens
# ---------------------------------------------------------------------------

def residual_missing(df: DataFrame, cols: Sequence[str] | None = None,
                     tokens: Iterable[str] = RESIDUAL_TOKENS) -> DataFrame:
    """(column_name, n_null, n_token) for columns that still have either."""
    cols = list(cols) if cols is not None else list(df.columns)
    tokens = tuple(tokens)
    dt = dict(df.dtypes)
    packed = df.agg(*[F.struct(F.count_if(F.col(c).isNull()).alias("n_null"),
                               F.count_if(is_token(c, tokens, dt[c])).alias("n_token")).alias(c) for c in cols])
    long = packed.unpivot([], cols, "column_name", "s")
    return (long.select("column_name", "s.n_null", "s.n_token")
                .filter((F.col("n_null") + F.col("n_token")) > 0))
