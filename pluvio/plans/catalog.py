"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads the given tables (through the ``obs`` mapping or the
``lineitem`` score frame), so its work grows with the scale factor.
``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
equivalent SQL text (absent for model fitting, which SQL cannot express).
"""

from __future__ import annotations

from itertools import combinations
from typing import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..config import AUDIT_TOKENS, DIRECTIONS, RESIDUAL_TOKENS, WEATHER, YES_NO
from .. import session
from ..operators import audit, histogram, joins
from ..functions.predicates import complete_rows
from ..sources.obs import obs
from . import sqltext as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Means are rounded before they fill gaps, so that no summation order shows in the compared values.
SPEC = WEATHER.with_(mean_decimals=9)
COLS = list(SPEC.columns)
_NORMAL, _CONT, _DISC = list(SPEC.normal), list(SPEC.continuous), list(SPEC.discrete)
_NUMERIC = list(SPEC.numeric)
_ANY_NUM = "(" + " OR ".join(f"{S.q(c)} IS NOT NULL" for c in _NUMERIC) + ")"


#: Queries whose doubles are rounded to 9 decimals here, as their SQL does; operators return full precision.
ROUNDED = frozenset("""numeric_summary corr_matrix corr_with_label collinear_pairs error_interval rates_by_label weighted_rates f1
    roc_curve auc_roc auc_roc_hard auc_pr evaluate_tree evaluate_forest majority_baseline rate_by_month rate_by_top_location direction_to_vector row_means daily_means cyclic_month standardize build_features feature_vector model_set_elements""".split())


def rounded(df: DataFrame, decimals: int = 9) -> DataFrame:
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, decimals) for c, t in df.dtypes if t == "double"})


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = (lambda spark, sf: rounded(fn(spark, sf))) if name in ROUNDED else fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Audit (Q1-Q15)
# ---------------------------------------------------------------------------

_miss_sel = ", ".join(f"{S.cnt(S.missing(c))} AS {S.q(c)}" for c in COLS)
_MISSING_SQL = S.with_obs(f"""
SELECT column_name, n_missing, {S.pct('n_missing', 'n_rows')} AS pct
FROM (UNPIVOT (SELECT count(*) AS n_rows, {_miss_sel} FROM obs)
      ON {', '.join(S.q(c) for c in COLS)} INTO NAME column_name VALUE n_missing)
""")


@register("missing_profile", _MISSING_SQL)
def q_missing_profile(spark, sf):
    return audit.missing_profile(obs(spark, sf))


_complete = " AND ".join(f"NOT {S.missing(c)}" for c in COLS)
_COMPLETE_SQL = S.with_obs(f"""
SELECT n_rows, n_complete, n_rows - n_complete AS n_incomplete, {S.pct('n_complete', 'n_rows')} AS pct_complete
FROM (SELECT count(*) AS n_rows, {S.cnt(_complete)} AS n_complete FROM obs)
""")


@register("completeness", _COMPLETE_SQL)
def q_completeness(spark, sf):
    return audit.completeness(obs(spark, sf))


DOMAINS = {"RainToday": YES_NO, "RainTomorrow": YES_NO,
           **{c: DIRECTIONS for c in SPEC.directions}}

_DOMAIN_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, CAST({S.q(c)} AS VARCHAR) AS value, count(*) AS n_rows FROM obs "
    f"WHERE {S.q(c)} IS NOT NULL AND {S.q(c)} NOT IN ({S.lit_list(d)}) GROUP BY 2"
    for c, d in DOMAINS.items()))


@register("domain_violations", _DOMAIN_SQL)
def q_domain_violations(spark, sf):
    return audit.domain_violations(obs(spark, sf), DOMAINS)


def _oor(c, lo, hi):
    v = f"TRY_CAST({S.q(c)} AS DOUBLE)"
    return f"{v} IS NOT NULL AND NOT isnan({v}) AND ({v} < {lo} OR {v} > {hi})"


_RANGE_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi, "
    f"{S.cnt(_oor(c, lo, hi))} AS n_out FROM obs"
    for c, (lo, hi) in SPEC.ranges.items()))


@register("range_violations", _RANGE_SQL)
def q_range_violations(spark, sf):
    return audit.range_violations(obs(spark, sf))


_BAD_DATE = "(Date IS NOT NULL AND try_strptime(Date, '%Y-%m-%d') IS NULL)"
_INVALID_DATES_SQL = S.with_obs(f"""
SELECT Date, Location FROM obs WHERE {_BAD_DATE}
ORDER BY Location ASC NULLS FIRST, Date ASC NULLS FIRST LIMIT 20
""")


@register("invalid_dates", _INVALID_DATES_SQL)
def q_invalid_dates(spark, sf):
    return audit.invalid_dates(obs(spark, sf))


@register("invalid_date_report", S.with_obs(f"""
SELECT Date, Location, (SELECT count(*) FROM obs WHERE {_BAD_DATE}) AS n_invalid FROM obs WHERE {_BAD_DATE}
ORDER BY Location ASC NULLS FIRST, Date ASC NULLS FIRST LIMIT 20
"""))
def q_invalid_date_report(spark, sf):
    return audit.invalid_date_report(obs(spark, sf))


_DATE_SPAN_SQL = S.with_obs(f"""
SELECT min(CAST(try_strptime(Date, '%Y-%m-%d') AS DATE)) AS first_date,
       max(CAST(try_strptime(Date, '%Y-%m-%d') AS DATE)) AS last_date,
       {S.cnt(_BAD_DATE)} AS n_invalid
FROM obs
""")


@register("date_span", _DATE_SPAN_SQL)
def q_date_span(spark, sf):
    return audit.date_span(obs(spark, sf))


BOOL_COLS = list(SPEC.binary)
_BOOL_FREQ_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, CAST({S.q(c)} AS VARCHAR) AS value, count(*) AS n FROM obs GROUP BY 2"
    for c in BOOL_COLS))


@register("boolean_frequencies", _BOOL_FREQ_SQL)
def q_boolean_frequencies(spark, sf):
    o = obs(spark, sf)
    return audit.boolean_frequencies(o, audit.boolean_columns(o, BOOL_COLS))


def _bool_profile_sql(c):
    t = f"lower(CAST({S.q(c)} AS VARCHAR))"
    return (f"SELECT '{c}' AS column_name, n AS n_non_null, {S.pct('t', 'n')} AS pct_true, "
            f"{S.pct('f', 'n')} AS pct_false, {S.pct('n - t - f', 'n')} AS pct_other FROM "
            f"(SELECT count({S.q(c)}) AS n, {S.cnt(f'{t} IN (' + S.lit_list(audit.TRUE_TEXT) + ')')} AS t, "
            f"{S.cnt(f'{t} IN (' + S.lit_list(audit.FALSE_TEXT) + ')')} AS f FROM obs)")


_BOOL_PROFILE_SQL = S.with_obs(S.union_all(_bool_profile_sql(c) for c in BOOL_COLS))


@register("boolean_profile", _BOOL_PROFILE_SQL)
def q_boolean_profile(spark, sf):
    return audit.boolean_profile(obs(spark, sf), BOOL_COLS)


_ALL = ", ".join(S.q(c) for c in COLS)
_GROUPED = f"g AS (SELECT {_ALL}, count(*) AS n FROM obs GROUP BY ALL)"
_DUP_SQL = S.with_obs(f"""
SELECT n_rows, n_distinct, n_rows - n_distinct AS n_duplicates, {S.pct('n_rows - n_distinct', 'n_rows')} AS pct_duplicates
FROM (SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct FROM g)
""", _GROUPED)


@register("duplicate_summary", _DUP_SQL)
def q_duplicate_summary(spark, sf):
    return audit.duplicate_summary(obs(spark, sf))


_SHOW = ["Date", "Location", "MinTemp", "MaxTemp", "Rainfall", "RainToday", "RainTomorrow"]
_TOPDUP_SQL = S.with_obs(f"""
SELECT n AS n_copies, {', '.join(S.q(c) for c in _SHOW)} FROM g WHERE n > 1
ORDER BY n DESC, {', '.join(S.q(c) + ' ASC NULLS FIRST' for c in _SHOW)} LIMIT 5
""", _GROUPED)


@register("top_duplicates", _TOPDUP_SQL)
def q_top_duplicates(spark, sf):
    return audit.top_duplicates(obs(spark, sf))


_SCORE_SQL = S.with_obs(f"""
SELECT round(CAST(n_complete AS DOUBLE) * 100.0 / n_rows, 6) AS pct_complete,
       {S.pct('n_rows - n_distinct', 'n_rows')} AS pct_duplicates,
       round((CAST(n_complete AS DOUBLE) * 100.0 / n_rows) * (1 - CAST(n_rows - n_distinct AS DOUBLE) / n_rows), 6) AS score
FROM (SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
             CAST(sum(CASE WHEN {_complete} THEN n ELSE 0 END) AS BIGINT) AS n_complete FROM g)
""", _GROUPED)


@register("quality_score", _SCORE_SQL)
def q_quality_score(spark, sf):
    return audit.quality_score(obs(spark, sf))


_RANGE_COLS = list(SPEC.ranges)
_wmiss = ", ".join(f"CAST(sum(CASE WHEN {S.missing(c)} THEN n ELSE 0 END) AS BIGINT) AS {S.q('miss_' + c)}" for c in COLS)
_wrange = " + ".join(f"CAST(sum(CASE WHEN {_oor(c, *SPEC.ranges[c])} THEN n ELSE 0 END) AS BIGINT)" for c in _RANGE_COLS)
_REPORT_SQL = S.with_obs(f"""
SELECT 'quality_score' AS metric,
       round((CAST(n_complete AS DOUBLE) * 100.0 / n_rows) * (1 - CAST(n_rows - n_distinct AS DOUBLE) / n_rows), 6) AS value,
       CAST(NULL AS DOUBLE) AS pct FROM c
UNION ALL SELECT 'incomplete_rows', CAST(n_rows - n_complete AS DOUBLE), {S.pct('n_rows - n_complete', 'n_rows')} FROM c
UNION ALL SELECT 'duplicate_rows', CAST(n_rows - n_distinct AS DOUBLE), {S.pct('n_rows - n_distinct', 'n_rows')} FROM c
UNION ALL SELECT 'invalid_dates', CAST(n_bad AS DOUBLE), {S.pct('n_bad', 'n_rows')} FROM c
UNION ALL SELECT 'out_of_range', CAST(n_oor AS DOUBLE), {S.pct('n_oor', 'n_rows')} FROM c
UNION ALL SELECT 'missing:' || column_name, CAST(n_missing AS DOUBLE), {S.pct('n_missing', 'n_rows')}
FROM (SELECT *, row_number() OVER (ORDER BY n_missing DESC, column_name) AS rk
      FROM (UNPIVOT (SELECT n_rows, {', '.join(S.q('miss_' + x) + ' AS ' + S.q(x) for x in COLS)} FROM c)
            ON {', '.join(S.q(x) for x in COLS)} INTO NAME column_name VALUE n_missing))
WHERE rk <= 15
""", _GROUPED, f"""c AS (SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
    CAST(sum(CASE WHEN {_complete} THEN n ELSE 0 END) AS BIGINT) AS n_complete,
    CAST(sum(CASE WHEN {_BAD_DATE} THEN n ELSE 0 END) AS BIGINT) AS n_bad,
    {_wrange} AS n_oor, {_wmiss} FROM g)""")


@register("quality_report", _REPORT_SQL)
def q_quality_report(spark, sf):
    return audit.quality_report(obs(spark, sf))


_pairs_sel = ", ".join(
    f"{S.cnt(S.missing(a) + ' AND ' + S.missing(b))} AS {S.q(a + '|' + b)}" for a, b in combinations(COLS, 2))
_COOC_SQL = S.with_obs(f"""
SELECT CASE WHEN ra.rk < rb.rk THEN p.a ELSE p.b END AS col_a,
       CASE WHEN ra.rk < rb.rk THEN p.b ELSE p.a END AS col_b,
       p.n AS n_both, {S.pct('p.n', 'p.n_rows')} AS pct
FROM (SELECT split_part(k, '|', 1) AS a, split_part(k, '|', 2) AS b, n, n_rows
      FROM (UNPIVOT (SELECT count(*) AS n_rows, {_pairs_sel} FROM obs)
            ON {', '.join(S.q(a + '|' + b) for a, b in combinations(COLS, 2))} INTO NAME k VALUE n)) p
JOIN top5 ra ON p.a = ra.column_name JOIN top5 rb ON p.b = rb.column_name
""", f"""top5 AS (SELECT column_name, rk FROM (
    SELECT column_name, row_number() OVER (ORDER BY n_missing DESC, column_name) AS rk
    FROM (UNPIVOT (SELECT {_miss_sel} FROM obs) ON {', '.join(S.q(c) for c in COLS)}
          INTO NAME column_name VALUE n_missing)) WHERE rk <= 5)""")


@register("missing_cooccurrence", _COOC_SQL)
def q_missing_cooccurrence(spark, sf):
    return audit.missing_cooccurrence(obs(spark, sf))


_RESID_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, {S.cnt(S.q(c) + ' IS NULL')} AS n_null, "
    f"{S.cnt(S.token(c, RESIDUAL_TOKENS))} AS n_token FROM obs HAVING n_null + n_token > 0"
    for c in COLS))


@register("residual_missing", _RESID_SQL)
def q_residual_missing(spark, sf):
    return audit.residual_missing(obs(spark, sf), COLS)


__all__ = ["QUERIES", "ORACLE", "AUDIT_TOKENS"]


# ---------------------------------------------------------------------------
# Statistics and exploration (A1-A10, U*), correlation
# ---------------------------------------------------------------------------

from ..operators import correlation, explore  # noqa: E402

NUM = list(SPEC.audit_numeric)
_D = lambda c: f"TRY_CAST({S.q(c)} AS DOUBLE)"

_SUMMARY_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, min({_D(c)}) AS min, max({_D(c)}) AS max, "
    f"round(avg({_D(c)}), 9) AS mean, round(stddev_samp({_D(c)}), 9) AS stddev FROM obs" for c in NUM))


@register("numeric_summary", _SUMMARY_SQL)
def q_numeric_summary(spark, sf):
    return explore.numeric_summary(obs(spark, sf))


_PROBS = (0.01, 0.05, 0.50, 0.95, 0.99)
_PCTL_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, "
    + ", ".join(f"quantile_disc({_D(c)}, {p}) AS {explore.prob_name(p)}" for p in _PROBS)
    + f" FROM obs HAVING count({_D(c)}) > 0" for c in NUM))


@register("percentiles", _PCTL_SQL)
def q_percentiles(spark, sf):
    return explore.percentiles(obs(spark, sf))


_VALID = "RainTomorrow IN ('Yes', 'No')"
_BALANCE_SQL = S.with_obs(f"""
SELECT RainTomorrow, n, round(CAST(n AS DOUBLE) * 100.0 / sum(n) OVER (), 6) AS pct
FROM (SELECT RainTomorrow, count(*) AS n FROM obs WHERE {_VALID} GROUP BY 1)
""")


@register("class_balance", _BALANCE_SQL)
def q_class_balance(spark, sf):
    return explore.class_balance(obs(spark, sf))


_BASELINE_SQL = S.with_obs(f"""
SELECT arg_max(RainTomorrow, n * 1000000 + CASE WHEN RainTomorrow = 'Yes' THEN 1 ELSE 0 END) AS majority_label,
       max(n) AS n_majority, CAST(sum(n) AS BIGINT) AS n_total, round(CAST(max(n) AS DOUBLE) / sum(n), 9) AS accuracy
FROM (SELECT RainTomorrow, count(*) AS n FROM obs WHERE {_VALID} GROUP BY 1)
""")


@register("majority_baseline", _BASELINE_SQL)
def q_majority_baseline(spark, sf):
    return explore.majority_baseline(obs(spark, sf))


CAT = list(SPEC.categorical)
_CARD_SQL = S.with_obs(S.union_all(
    f"SELECT '{c}' AS column_name, count(DISTINCT {S.q(c)}) AS n_distinct FROM obs" for c in CAT))


@register("cardinality", _CARD_SQL)
def q_cardinality(spark, sf):
    return explore.cardinality(obs(spark, sf))


_VC = S.union_all(
    f"SELECT '{c}' AS column_name, CAST({S.q(c)} AS VARCHAR) AS value, count(*) AS n FROM obs GROUP BY 2" for c in CAT)
_TOPK_SQL = S.with_obs(f"""
SELECT * FROM (SELECT column_name, value, n,
                      CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC) AS INTEGER) AS rank
               FROM vc WHERE value IS NOT NULL) WHERE rank <= 10
""", f"vc AS ({_VC})")


@register("top_k", _TOPK_SQL)
def q_top_k(spark, sf):
    return explore.top_k(obs(spark, sf))


_RARE_SQL = S.with_obs("SELECT column_name, value, n FROM vc WHERE n < 50", f"vc AS ({_VC})")


@register("rare_categories", _RARE_SQL)
def q_rare_categories(spark, sf):
    return explore.rare_categories(obs(spark, sf))


_NO_TOKENS = f"vc AS (SELECT * FROM ({_VC}) v WHERE NOT {S.missing('value')})"


@register("top_k_present", S.with_obs("""
SELECT * FROM (SELECT column_name, value, n,
                      CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value ASC) AS INTEGER) AS rank
               FROM vc) WHERE rank <= 10
""", _NO_TOKENS))
def q_top_k_present(spark, sf):
    return explore.top_k(obs(spark, sf), drop_missing=True)


@register("rare_present", S.with_obs("SELECT column_name, value, n FROM vc WHERE n < 50", _NO_TOKENS))
def q_rare_present(spark, sf):
    return explore.rare_categories(obs(spark, sf), drop_missing=True)


_MONTH = "CAST(month(CAST(try_strptime(Date, '%Y-%m-%d') AS DATE)) AS INTEGER)"
_RATE_MONTH_SQL = S.with_obs(f"""
SELECT {_MONTH} AS Month, round(avg(CASE WHEN RainTomorrow = 'Yes' THEN 1 ELSE 0 END), 9) AS rate, count(*) AS n
FROM obs WHERE {_VALID} GROUP BY 1
""")


@register("rate_by_month", _RATE_MONTH_SQL)
def q_rate_by_month(spark, sf):
    return explore.rate_by(explore.with_month(obs(spark, sf)), ["Month"])


_RATE_TOP_SQL = S.with_obs(f"""
SELECT Location, round(avg(CASE WHEN RainTomorrow = 'Yes' THEN 1 ELSE 0 END), 9) AS rate, count(*) AS n
FROM obs WHERE {_VALID} GROUP BY 1 ORDER BY n DESC, Location ASC LIMIT 10
""")


@register("rate_by_top_location", _RATE_TOP_SQL)
def q_rate_by_top_location(spark, sf):
    return explore.rate_by_top(obs(spark, sf))


_OUTSIDE_SQL = S.with_obs(
    f"SELECT DISTINCT WindGustDir FROM obs WHERE WindGustDir IS NOT NULL AND WindGustDir NOT IN ({S.lit_list(DIRECTIONS)})")


@register("outside_domain", _OUTSIDE_SQL)
def q_outside_domain(spark, sf):
    return explore.outside_domain(obs(spark, sf), "WindGustDir", DIRECTIONS)


_DISTINCT_SQL = S.with_obs(f"SELECT DISTINCT {_ALL} FROM obs")


@register("distinct_rows", _DISTINCT_SQL)
def q_distinct_rows(spark, sf):
    return explore.distinct_rows(obs(spark, sf).select(*COLS))


_CPAIRS = list(combinations(NUM, 2))
_COMPLETE_NUM = " AND ".join(f"{_D(c)} IS NOT NULL AND NOT isnan({_D(c)})" for c in NUM)
_CORR_SQL = S.with_obs(S.union_all(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({_D(a)}, {_D(b)}), 9) AS r FROM obs "
    f"WHERE {_VALID} AND {_COMPLETE_NUM}" for a, b in _CPAIRS))


@register("corr_matrix", _CORR_SQL)
def q_corr_matrix(spark, sf):
    return correlation.corr_matrix(obs(spark, sf))


_CORR_LABEL_SQL = S.with_obs(f"""
SELECT * FROM ({S.union_all(
    f"SELECT '{c}' AS column_name, round(corr({_D(c)}, CASE WHEN RainTomorrow = 'Yes' THEN 1.0 ELSE 0.0 END), 9) AS r "
    f"FROM obs WHERE {_VALID}" for c in NUM)}) WHERE r IS NOT NULL AND NOT isnan(r)
""")


@register("corr_with_label", _CORR_LABEL_SQL)
def q_corr_with_label(spark, sf):
    return correlation.corr_with_label(obs(spark, sf))


_COLLINEAR_SQL = S.with_obs(f"SELECT * FROM ({S.union_all(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({_D(a)}, {_D(b)}), 9) AS r FROM obs "
    f"WHERE {_VALID} AND {_COMPLETE_NUM}" for a, b in _CPAIRS)}) WHERE abs(r) >= 0.9")


@register("collinear_pairs", _COLLINEAR_SQL)
def q_collinear_pairs(spark, sf):
    return correlation.collinear_pairs(obs(spark, sf))


_COVERAGE_SQL = S.with_obs(f"""
SELECT n_used, n_total, round(CAST(n_used AS DOUBLE) * 100.0 / n_total, 6) AS pct
FROM (SELECT {S.cnt(_VALID + ' AND ' + _COMPLETE_NUM)} AS n_used, count(*) AS n_total FROM obs)
""")


@register("corr_coverage", _COVERAGE_SQL)
def q_corr_coverage(spark, sf):
    return correlation.corr_coverage(obs(spark, sf))


# ---------------------------------------------------------------------------
# Split, outliers, group statistics, imputation cascade (X*, O*, G*, I*)
# ---------------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from ..operators import groupstats, impute, split  # noqa: E402
from . import prepare_sql as P  # noqa: E402
from .prepare import Preparation  # noqa: E402


def prep(spark, sf, materialize: bool = True) -> Preparation:
    """The cascade for one query; ``materialize=False`` where each stage is read once."""
    return Preparation(obs(spark, sf), SPEC, materialize_stages=materialize)


@register("hash_split", P.chain(f"""
SELECT CASE WHEN {P.BUCKET} < 8 THEN 'train' ELSE 'test' END AS split, RainTomorrow, count(*) AS n
FROM norm GROUP BY ALL"""))
def q_hash_split(spark, sf):
    p = prep(spark, sf)
    return split.split_label(p.normalized).groupBy("split", "RainTomorrow").agg(F.count(F.lit(1)).alias("n"))


_DIGEST = "('0x' || substr(md5(CAST(h AS VARCHAR)), 1, 13))::BIGINT"


@register("stratified_split", P.chain(f"""
SELECT h, RainTomorrow, CASE WHEN row_number() OVER (PARTITION BY RainTomorrow ORDER BY {_DIGEST})
    <= floor(0.8::DOUBLE * count(*) OVER (PARTITION BY RainTomorrow) + 0.5) THEN 'train' ELSE 'test' END AS split FROM norm"""))
def q_stratified_split(spark, sf):
    return split.exact_stratified(prep(spark, sf).normalized.select("h", "RainTomorrow"))


_MOSTLY_NULL = "CASE WHEN substr(md5(CAST(h AS VARCHAR)), 1, 1) = '0' THEN Location END"


@register("join_null_keys", P.chain(f"""
, few AS (SELECT h, {_MOSTLY_NULL} AS Location, RainTomorrow FROM norm),
means AS (SELECT Location, RainTomorrow, avg(MaxTemp) AS mean, count(*) AS n FROM norm GROUP BY ALL)
SELECT h, Location, RainTomorrow, round(mean, 9) AS mean, n FROM few LEFT JOIN means USING (Location, RainTomorrow)"""))
def q_join_null_keys(spark, sf):
    """15 of 16 rows have no Location; a key of more than 1000 rows is dealt to eight parts."""
    norm = prep(spark, sf).normalized
    means = norm.groupBy("Location", "RainTomorrow").agg(F.avg("MaxTemp").alias("mean"), F.count(F.lit(1)).alias("n"))
    few = norm.select("h", F.expr(_MOSTLY_NULL.replace("VARCHAR", "string")).alias("Location"), "RainTomorrow")
    joined = joins.left_join(session.materialize(few), [means], ["Location", "RainTomorrow"], hot_rows=1000, salts=8)
    return joined.select("h", "Location", "RainTomorrow", F.round("mean", 9).alias("mean"), "n")


@register("semi_join_top", P.chain("""
SELECT Location, RainTomorrow, count(*) AS n FROM norm WHERE Location IN
    (SELECT Location FROM norm WHERE Location IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, Location LIMIT 5) GROUP BY ALL"""))
def q_semi_join_top(spark, sf):
    norm = prep(spark, sf).normalized
    top = norm.filter("Location is not null").groupBy("Location").count().orderBy(F.desc("count"), "Location").limit(5)
    return joins.semi_join_top(norm, top, "Location").groupBy("Location", "RainTomorrow").agg(F.count(F.lit(1)).alias("n"))


#: Fixed cuts of the features that the histogram queries split on.
TREE_CUTS = {"Humidity3pm": range(10, 100, 10), "Pressure3pm": range(990, 1030, 5), "Rainfall": (0.5, 1, 2, 5, 10, 15),
             "Temp3pm": range(5, 35, 5), "WindGustSpeed": range(30, 80, 10)}


def _bin_sql(c, cuts):
    own = ", ".join(f"{float(x)}" for x in cuts)
    return f"CASE WHEN {S.q(c)} IS NULL OR isnan({S.q(c)}) THEN 0 ELSE 1 + len(list_filter([{own}], lambda x: x <= {S.q(c)})) END AS {S.q(c)}"


def _gain_ctes(name, src, by):
    """Counts, gains and the best split per ``by`` (and feature, if that is in it) over ``src``."""
    keys = ", ".join(by)
    groups = ", ".join(b for b in by if b != "feature")
    lead = f"{groups}, " if groups else ""
    counts = S.union_all(f"SELECT {lead}'{c}' AS feature, {S.q(c)} AS bin, count(*) AS n, sum(y) AS p FROM {src} GROUP BY ALL" for c in TREE_CUTS)
    over = f"PARTITION BY {lead}feature"
    g = "(1 - ({p} * {p} + ({n} - {p}) * ({n} - {p})) / ({n} * {n}))".format
    return [f"{name}_counts AS ({counts})",
            f"{name}_sums AS (SELECT {lead}feature, bin, sum(n) OVER ({over} ORDER BY bin)::DOUBLE AS ln, sum(p) OVER ({over} ORDER BY bin)::DOUBLE AS lp, "
            f"sum(n) OVER ({over})::DOUBLE AS an, sum(p) OVER ({over})::DOUBLE AS ap FROM {name}_counts)",
            f"{name}_gains AS (SELECT *, {g(n='an', p='ap')} - ln / an * {g(n='ln', p='lp')} - (an - ln) / an * {g(n='(an - ln)', p='(ap - lp)')} AS gain "
            f"FROM {name}_sums WHERE ln < an)",
            f"{name}_best AS (SELECT {lead}feature, CAST(bin AS INTEGER) AS bin, an::BIGINT AS n, ap::BIGINT AS positive, gain FROM {name}_gains WHERE round(gain, 12) > 0 "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round(gain, 12) DESC, feature, bin) = 1)"]


_BINNED = [f"binned AS (SELECT 1 AS node, {P.FOLD.format(k=5)} AS fold, CASE WHEN RainTomorrow = 'Yes' THEN 1 ELSE 0 END AS y, "
           + ", ".join(_bin_sql(c, cuts) for c, cuts in TREE_CUTS.items()) + " FROM norm)"]
_SIDE = "CASE root.feature " + " ".join(f"WHEN '{c}' THEN b.{S.q(c)}" for c in TREE_CUTS) + " END"
_CHILDREN = [f"children AS (SELECT b.* REPLACE (CASE WHEN {_SIDE} <= root.bin THEN 2 ELSE 3 END AS node) FROM binned b, root_best root)"]
_SPLIT_COLS = "node, feature, bin, n, positive, round(gain, 9) AS gain"


def _binned(spark, sf):
    norm = prep(spark, sf).normalized
    label = norm.select("*", F.when(F.col("RainTomorrow") == "Yes", 1).otherwise(0).alias("label"))
    return histogram.bin_columns(split.assign_folds(label, 5), TREE_CUTS, ["fold", "label"])


@register("tree_splits", P.chain(", " + ",\n".join([*_BINNED, *_gain_ctes("root", "binned", ["node"]), *_CHILDREN, *_gain_ctes("child", "children", ["node"])])
                                 + f"\nSELECT {_SPLIT_COLS} FROM root_best UNION ALL SELECT {_SPLIT_COLS} FROM child_best"))
def q_tree_splits(spark, sf):
    found = histogram.grow(session.materialize(_binned(spark, sf)), list(TREE_CUTS))
    return found.withColumn("gain", F.round("gain", 9))


_TRAINS = [f"trains AS (SELECT f.fold AS of, b.* EXCLUDE (fold), CAST(f.fold AS INTEGER) AS fold FROM binned b, range(5) f(fold) WHERE b.fold <> f.fold)"]


@register("fold_splits", P.chain(", " + ",\n".join([*_BINNED, *_TRAINS, *_gain_ctes("cv", "trains", ["fold", "feature"])])
                                 + "\nSELECT fold, feature, bin, n, positive, round(gain, 9) AS gain FROM cv_best"))
def q_fold_splits(spark, sf):
    found = histogram.fold_splits(_binned(spark, sf), list(TREE_CUTS), 5)
    return found.withColumn("gain", F.round("gain", 9))


@register("assign_folds", P.chain(f"SELECT CAST({P.FOLD.format(k=5)} AS INTEGER) AS fold, count(*) AS n FROM train GROUP BY 1"))
def q_assign_folds(spark, sf):
    p = prep(spark, sf)
    return split.assign_folds(p.split[0], 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@register("iqr_bounds", P.chain("SELECT * FROM bounds"))
def q_iqr_bounds(spark, sf):
    # the fences alone: only their columns are stored
    return iqr_bounds(prep(spark, sf).split[0], SPEC.outliers, spec=SPEC)


@register("null_outliers", P.chain(P.select_out("trc")))
def q_null_outliers(spark, sf):
    return prep(spark, sf, materialize=False).train_clean


@register("group_stats_label", P.chain("SELECT * FROM st3"))
def q_group_stats_label(spark, sf):
    p = prep(spark, sf, materialize=False)
    return impute.tier1_stats(p.train_clean, p.keys3, SPEC)


@register("group_stats", P.chain("SELECT * FROM st2"))
def q_group_stats(spark, sf):
    p = prep(spark, sf, materialize=False)
    return impute.tier1_stats(p.train_clean, p.keys2, SPEC)


def _wide_sql(keys):
    both, k = _NORMAL + _CONT, ", ".join(S.q(x) for x in keys)
    aggs = [f"round(avg({S.q(c)}), 9) AS {S.q(c + '_mean')}, quantile_disc({S.q(c)}, 0.5) AS {S.q(c + '_median')}" for c in both]
    aggs += [f"avg({S.q(c)}) AS {S.q(c + '_mean')}" for c in _DISC]
    return P.chain(f"SELECT {k}, {', '.join(aggs)} FROM trc WHERE {_ANY_NUM} GROUP BY {k}")


@register("group_stats_wide_label", _wide_sql(P.K3))
def q_group_stats_wide_label(spark, sf):
    p = prep(spark, sf, materialize=False)
    return impute.wide_stats(p.train_clean, p.keys3, SPEC)


@register("group_stats_wide", _wide_sql(P.K2))
def q_group_stats_wide(spark, sf):
    p = prep(spark, sf, materialize=False)
    return impute.wide_stats(p.train_clean, p.keys2, SPEC)


@register("group_modes", P.chain("SELECT * FROM md3"))
def q_group_modes(spark, sf):
    p = prep(spark, sf, materialize=False)
    return impute.tier1_modes(p.train_clean, p.keys3)


@register("impute_tier1_train", P.chain(P.select_out("trn")))
def q_impute_tier1_train(spark, sf):
    p = prep(spark, sf)
    return impute.impute_group_numeric(p.train_clean, p.train_clean, p.keys3, SPEC)


@register("impute_tier1_test", P.chain(P.select_out("ten")))
def q_impute_tier1_test(spark, sf):
    p = prep(spark, sf)
    return impute.impute_group_numeric(p.test_clean, p.train_clean, p.keys2, SPEC)


_RT_TRAIN_SQL = P.chain(f"""
SELECT {', '.join(('CASE WHEN ' + S.missing('RainToday') + ' THEN RainToday_mode ELSE RainToday END AS RainToday')
                  if c == 'RainToday' else S.q(c) for c in P.OUT)}
FROM (SELECT * REPLACE (upper(trim(RainToday)) AS RainToday) FROM trc) x LEFT JOIN rm USING (RainTomorrow)""")


@register("impute_raintoday_train", _RT_TRAIN_SQL)
def q_impute_raintoday_train(spark, sf):
    p = prep(spark, sf)
    return impute.impute_raintoday_train(p.train_clean, p.train_clean)


@register("impute_raintoday_test", P.chain(P.select_out("ter")))
def q_impute_raintoday_test(spark, sf):
    p = prep(spark, sf)
    return impute.impute_raintoday_test(impute.impute_group_numeric(p.test_clean, p.train_clean, p.keys2, SPEC))


@register("impute_wind_train", P.chain(f"SELECT {', '.join(P._wind_fill(c) for c in P.OUT)} FROM trc LEFT JOIN md3 {P._using(P.K3)}"))
def q_impute_wind_train(spark, sf):
    p = prep(spark, sf)
    return impute.impute_group_mode(p.train_clean, p.train_clean, p.keys3)


@register("impute_wind_test", P.chain(f"SELECT {', '.join(P._wind_fill(c) for c in P.OUT)} FROM tec LEFT JOIN md2 {P._using(P.K2)}"))
def q_impute_wind_test(spark, sf):
    p = prep(spark, sf)
    return impute.impute_group_mode(p.test_clean, p.train_clean, p.keys2)


@register("impute_tier2_train", P.chain(P.select_out("tr2")))
def q_impute_tier2_train(spark, sf):
    p = prep(spark, sf)
    return impute.impute_secondary(p.train_tier1, p.train_tier1, SPEC.label, stored=True)


@register("impute_tier2_test", P.chain(P.select_out("te2")))
def q_impute_tier2_test(spark, sf):
    p = prep(spark, sf)
    return impute.impute_secondary(p.test_tier1, p.train_tier1, infer_flag=True, stored=True)


@register("prepare_train", P.chain(P.select_out("trf")))
def q_prepare_train(spark, sf):
    return prep(spark, sf).train_final


@register("prepare_test", P.chain(P.select_out("tef")))
def q_prepare_test(spark, sf):
    return prep(spark, sf).test_final


# ---------------------------------------------------------------------------
# Features (F*) and classifier metrics on a fixed score (E*)
# ---------------------------------------------------------------------------

from ..config import ROW_MEANS  # noqa: E402
from ..operators import features, metrics  # noqa: E402


def score_frame(spark, sf):
    """lineitem as a scored binary sample: label = open line, score = quantity/50 + 0.2·label."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_quantity", "l_linestatus")
    label = F.when(F.col("l_linestatus") == "O", F.lit(1.0)).otherwise(F.lit(0.0))
    s = li.select(label.alias("label"), (F.col("l_quantity") / 50 + F.lit(0.2) * label).alias("score"))
    return s.withColumn("prediction", F.when(F.col("score") > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)))


_S_CTE = ("s AS (SELECT label, score, CASE WHEN score > 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction "
          "FROM (SELECT CAST(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS label, l_quantity, l_linestatus "
          "FROM lineitem) x, LATERAL (SELECT l_quantity / 50 + 0.2 * label AS score) y)")
_CELLS = ("cells AS (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE label = {a} AND prediction = {b}) AS c_{i}_{j}"
    for i, a in enumerate((0.0, 1.0)) for j, b in enumerate((0.0, 1.0))) + " FROM s)")


def _with_s(body, *more):
    return f"WITH {_S_CTE}, {_CELLS}" + "".join(f", {m}" for m in more) + f"\n{body}"


_N = "(c_0_0 + c_0_1 + c_1_0 + c_1_1)"
_ACC = f"(CAST(c_0_0 + c_1_1 AS DOUBLE) / {_N})"
_ERR = f"(1 - {_ACC})"
_STD = f"sqrt({_ERR} * (1 - {_ERR}) / {_N})"


@register("error_interval", _with_s(f"""
SELECT {_N} AS n, round({_ACC}, 9) AS accuracy, round({_ERR}, 9) AS error_rate, round({_STD}, 9) AS error_std,
       round({_ERR} - 1.96 * {_STD}, 9) AS ci_low, round({_ERR} + 1.96 * {_STD}, 9) AS ci_high FROM cells"""))
def q_error_interval(spark, sf):
    return metrics.error_rate(score_frame(spark, sf))


@register("confusion", _with_s("""
SELECT CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, n FROM (
  SELECT 0.0 AS label, 0.0 AS prediction, c_0_0 AS n FROM cells UNION ALL
  SELECT 0.0, 1.0, c_0_1 FROM cells UNION ALL SELECT 1.0, 0.0, c_1_0 FROM cells UNION ALL
  SELECT 1.0, 1.0, c_1_1 FROM cells)"""))
def q_confusion(spark, sf):
    return metrics.confusion(score_frame(spark, sf))


def _label_rates_sql():
    parts = []
    for i, v in enumerate((0.0, 1.0)):
        o = 1 - i
        n_i, p_i, tp = f"(c_{i}_{i} + c_{i}_{o})", f"(c_{i}_{i} + c_{o}_{i})", f"c_{i}_{i}"
        tpr = f"(CAST({tp} AS DOUBLE) / NULLIF({n_i}, 0))"
        fpr = f"(CAST({p_i} - {tp} AS DOUBLE) / NULLIF({_N} - {n_i}, 0))"
        prec = f"coalesce(CAST({tp} AS DOUBLE) / NULLIF({p_i}, 0), 0.0)"
        rec = f"coalesce({tpr}, 0.0)"
        f1 = f"coalesce(2 * {prec} * {rec} / NULLIF({prec} + {rec}, 0), 0.0)"
        share = f"(CAST({n_i} AS DOUBLE) / {_N})"
        parts.append(dict(label=v, n=n_i, tpr=tpr, fpr=fpr, prec=prec, f1=f1, share=share))
    return parts


_LR = _label_rates_sql()


@register("rates_by_label", _with_s(S.union_all(
    f"SELECT CAST({r['label']} AS DOUBLE) AS label, {r['n']} AS n, round({r['tpr']}, 9) AS tpr, round({r['fpr']}, 9) AS fpr, "
    f"round({r['prec']}, 9) AS precision, round({r['f1']}, 9) AS f1 FROM cells" for r in _LR)))
def q_rates_by_label(spark, sf):
    return metrics.rates_by_label(score_frame(spark, sf))


def _w(key):
    return " + ".join(f"coalesce({r['share']} * {r[key]}, 0.0)" for r in _LR)


@register("weighted_rates", _with_s(
    f"SELECT round({_w('tpr')}, 9) AS weighted_tpr, round({_w('fpr')}, 9) AS weighted_fpr, "
    f"round({_w('prec')}, 9) AS weighted_precision, round({_w('f1')}, 9) AS weighted_f1 FROM cells"))
def q_weighted_rates(spark, sf):
    return metrics.weighted_rates(score_frame(spark, sf))


@register("f1", _with_s(f"SELECT round({_w('f1')}, 9) AS f1 FROM cells"))
def q_f1(spark, sf):
    return metrics.f1(score_frame(spark, sf))


def _points_cte(score_col: str, bins: int) -> list[str]:
    chunk = "rn - 1" if bins <= 0 else f"CASE WHEN d // {bins} >= 2 THEN (rn - 1) // (d // {bins}) ELSE rn - 1 END"
    return [
        f"c AS (SELECT CAST({score_col} AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1.0) AS pos, "
        f"count(*) FILTER (WHERE NOT (label = 1.0)) AS neg FROM s GROUP BY 1)",
        "r AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, row_number() OVER w AS rn, "
        "count(*) OVER () AS d, sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM c "
        "WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
        f"p AS (SELECT {chunk} AS chunk, min(score) AS threshold, sum(pos) AS pos, sum(neg) AS neg, "
        f"max(cum_pos) AS cum_pos, max(cum_neg) AS cum_neg, max(tot_pos) AS tot_pos, max(tot_neg) AS tot_neg "
        f"FROM r GROUP BY 1)",
    ]


BINS = 17


@register("roc_curve", _with_s("""
SELECT threshold, round(CAST(cum_neg AS DOUBLE) / tot_neg, 9) AS fpr, round(CAST(cum_pos AS DOUBLE) / tot_pos, 9) AS tpr FROM p
UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""", *_points_cte("score", BINS)))
def q_roc_curve(spark, sf):
    return metrics.roc_curve(score_frame(spark, sf), bins=BINS)


_AUC_ROC = ("SELECT round(sum((CAST(neg AS DOUBLE) / tot_neg) * ((2 * CAST(cum_pos AS DOUBLE) - pos) / (2 * CAST(tot_pos AS DOUBLE)))), 9) "
            "AS auc_roc FROM p")


@register("auc_roc", _with_s(_AUC_ROC, *_points_cte("score", BINS)))
def q_auc_roc(spark, sf):
    return metrics.auc_roc(score_frame(spark, sf), bins=BINS)


@register("auc_roc_hard", _with_s(_AUC_ROC, *_points_cte("prediction", 0)))
def q_auc_roc_hard(spark, sf):
    return metrics.auc_roc(score_frame(spark, sf), "prediction")


@register("auc_pr", _with_s("""
SELECT round(sum((CAST(pos AS DOUBLE) / tot_pos) * (pr + prev_pr) / 2), 9) AS auc_pr FROM (
  SELECT *, CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg) AS pr,
         CASE WHEN (cum_pos - pos) + (cum_neg - neg) = 0 THEN CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg)
              ELSE CAST(cum_pos - pos AS DOUBLE) / ((cum_pos - pos) + (cum_neg - neg)) END AS prev_pr FROM p)""",
    *_points_cte("score", BINS)))
def q_auc_pr(spark, sf):
    return metrics.auc_pr(score_frame(spark, sf), bins=BINS)


_MEANS_SQL = ", ".join(f"({' + '.join(S.q(i) for i in ins)}) / {float(len(ins))} AS {S.q(out)}" for out, ins in ROW_MEANS.items())


@register("row_means", P.chain(f"SELECT h, {_MEANS_SQL} FROM norm"))
def q_row_means(spark, sf):
    return features.with_row_means(prep(spark, sf).normalized).select("h", *ROW_MEANS)


@register("complete_rows", P.chain(f"SELECT h, Date, Location FROM norm WHERE NOT ({' OR '.join(S.missing(c) for c in COLS)})"))
def q_complete_rows(spark, sf):
    return complete_rows(prep(spark, sf).normalized, COLS).select("h", "Date", "Location")


@register("index_label", P.chain(
    "SELECT RainTomorrow, CAST(CASE WHEN RainTomorrow = 'Yes' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label, count(*) AS n "
    "FROM norm GROUP BY ALL"))
def q_index_label(spark, sf):
    from pyspark.ml.feature import StringIndexer
    n = prep(spark, sf).normalized
    idx = StringIndexer(inputCol="RainTomorrow", outputCol="label", stringOrderType="alphabetDesc").fit(n)
    return idx.transform(n).groupBy("RainTomorrow", "label").agg(F.count(F.lit(1)).alias("n"))


_FEAT = ["Rainfall", *ROW_MEANS]


@register("build_features", P.chain(
    f"SELECT h, Rainfall, {_MEANS_SQL}, CAST(CASE WHEN RainTomorrow = 'Yes' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label FROM trf"))
def q_build_features(spark, sf):
    p = prep(spark, sf)
    model = features.build_features(p.train_final)
    return model.transform(p.train_final).select("h", *_FEAT, "label")


@register("feature_vector", P.chain(
    f"SELECT h, Rainfall AS f0, {', '.join(f'{name} AS f{i}' for i, name in enumerate(ROW_MEANS, 1))}, RainTomorrow AS class_name "
    f"FROM (SELECT h, Rainfall, {_MEANS_SQL}, RainTomorrow FROM trf) t"))
def q_feature_vector(spark, sf):
    """The vector's elements in order, and the label mapped to its index and back."""
    p = prep(spark, sf)
    model = features.build_features(p.train_final)
    rows = features.label_map(model.transform(p.train_final), features.label_names(model), out="class_name")
    elements = vector_to_array("features")
    return rows.select("h", *[elements[i].alias(f"f{i}") for i in range(len(_FEAT))], "class_name")


# ---------------------------------------------------------------------------
# Models, tuning, scoring, evaluation (M*, E13, E15): rows-only checks
# ---------------------------------------------------------------------------

from pyspark.ml.functions import vector_to_array  # noqa: E402

from ..operators import model_table, models  # noqa: E402
from .evaluate import Modelling, evaluate  # noqa: E402

# Search grids of the reference scripts (fixed values).
TREE_COARSE = {"impurity": ["gini", "entropy"], "maxDepth": [3, 5, 7, 9]}
TREE_REFINE_BINS = [28, 32, 36]
FOREST_COARSE = {"maxBins": [28, 32, 36], "maxDepth": [5, 7, 9]}
FOREST_REFINE = {"maxBins": [24, 28, 30], "maxDepth": [9, 10, 11]}


def modelling(spark, sf) -> Modelling:
    return Modelling(prep(spark, sf))


def _predictions(model, frame):
    return model.transform(frame).select("h", "label", "prediction", vector_to_array("probability")[1].alias("p1"))


@register("fit_tree")
def q_fit_tree(spark, sf):
    m = modelling(spark, sf)
    return _predictions(m.tree(maxDepth=7, maxBins=28), m.test)


@register("fit_forest")
def q_fit_forest(spark, sf):
    m = modelling(spark, sf)
    return _predictions(m.forest(seed=2025), m.test)


@register("cross_validate")
def q_cross_validate(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    m = modelling(spark, sf)
    cvm = models.cross_validate(m.train, DecisionTreeClassifier(), TREE_COARSE, k=5, fold_col="fold")
    return models.cv_table(spark, cvm)


@register("tune_two_stage")
def q_tune_two_stage(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    m = modelling(spark, sf)
    cv1, cv2 = models.tune_two_stage(m.train, DecisionTreeClassifier(), TREE_COARSE, TREE_REFINE_BINS,
                                     k=5, fold_col="fold")
    return models.cv_table(spark, cv1, 1).unionByName(models.cv_table(spark, cv2, 2))


@register("tune_forest")
def q_tune_forest(spark, sf):
    prepared = prep(spark, sf)
    m = Modelling(prepared, k=3)
    cv1, cv2 = models.tune_two_stage(m.train, models.forest(seed=2025), FOREST_COARSE, k=3, fold_col="fold", refine=FOREST_REFINE)
    return models.cv_table(spark, cv1, 1).unionByName(models.cv_table(spark, cv2, 2))


@register("score")
def q_score(spark, sf):
    m = modelling(spark, sf)
    scored = m.tree(maxDepth=7, maxBins=28).transform(m.test)
    scored = features.label_map(scored, features.label_names(m.pipeline), "prediction", "predicted_class")
    return scored.select("h", "prediction", "predicted_class", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("probability"))


@register("score_by_nodes")
def q_score_by_nodes(spark, sf):
    """The forest's nodes as a table, the test side scored by their expressions."""
    m = modelling(spark, sf)
    nodes = model_table.node_table(m.forest(seed=2025), f"{session.shared_dir(spark)}/pluvio-model-{uuid4().hex}")
    return model_table.score_by_nodes(m.test, nodes, keep=["h", "label"])


@register("score_label")
def q_score_label(spark, sf):
    m = modelling(spark, sf)
    return metrics.score_label(m.tree(maxDepth=7, maxBins=28).transform(m.test))


@register("evaluate_tree")
def q_evaluate_tree(spark, sf):
    m = modelling(spark, sf)
    return evaluate(m.tree(maxDepth=7, maxBins=28).transform(m.test))


@register("evaluate_forest")
def q_evaluate_forest(spark, sf):
    m = modelling(spark, sf)
    return evaluate(m.forest(seed=2025).transform(m.test))


# ---------------------------------------------------------------------------
# README-level operators (R1-R13): daily series, circular directions, cleaning,
# retention, daily means, cyclic month, quantile bins, standardisation
# ---------------------------------------------------------------------------

from ..operators import series, transforms  # noqa: E402
from ..operators.outliers import iqr_bounds  # noqa: E402
from ..operators.split import hash_split  # noqa: E402



def _by_stats_sql(src, keys, normal, cont, disc):
    aggs = [f"round(avg({S.q(c)}), 9) AS {S.q(c + '_mean')}" for c in normal]
    aggs += [f"quantile_disc({S.q(c)}, 0.5) AS {S.q(c + '_median')}" for c in cont]
    aggs += [f"avg({S.q(c)}) AS {S.q(c + '_mean')}" for c in disc]
    k = ", ".join(S.q(x) for x in keys)
    return f"SELECT {k}, {', '.join(aggs)} FROM {src} WHERE {_ANY_NUM} GROUP BY {k}"


def _by_fill_sql(cols, normal, cont, disc):
    out = []
    for c in cols:
        if c in normal:
            out.append(f"coalesce({S.q(c)}, {S.q(c + '_mean')}) AS {S.q(c)}")
        elif c in disc:
            out.append(f"CASE WHEN {S.q(c)} IS NULL THEN CAST(round({S.q(c + '_mean')}) AS INTEGER) ELSE {S.q(c)} END AS {S.q(c)}")
        elif c in cont:
            out.append(f"coalesce({S.q(c)}, {S.q(c + '_median')}) AS {S.q(c)}")
        else:
            out.append(S.q(c))
    return ", ".join(out)


@register("impute_month", P.chain(
    f"SELECT {_by_fill_sql(P.OUT, _NORMAL, _CONT, _DISC)} FROM trc LEFT JOIN "
    f"({_by_stats_sql('trc', ['Month'], _NORMAL, _CONT, _DISC)}) st USING (Month)"))
def q_impute_month(spark, sf):
    p = prep(spark, sf)
    return series.impute_month(p.train_clean, p.train_clean, SPEC)


_DAILY_COLS = ["Location", "Date", *_NUMERIC, "Month"]
_DAILY = ("daily AS (SELECT Location, Date, " + ", ".join(f"round(avg({S.q(c)}), 9) AS {S.q(c)}" for c in _NUMERIC)
          + ", CAST(month(Date) AS INTEGER) AS Month FROM norm WHERE Date IS NOT NULL GROUP BY Location, Date)")
_W = "OVER (PARTITION BY Location ORDER BY Date)"
_NEIGH = ("neigh AS (SELECT Location, Date, " + ", ".join(
    f"CASE WHEN {S.q(c)} IS NULL THEN coalesce((lag({S.q(c)}) {_W} + lead({S.q(c)}) {_W}) / 2, "
    f"lag({S.q(c)}) {_W}, lead({S.q(c)}) {_W}) ELSE {S.q(c)} END AS {S.q(c)}" for c in _NUMERIC) + ", Month FROM daily)")


def _with_daily(body, *more):
    return S.with_obs(body, *P.ctes(), _DAILY, _NEIGH, *more)


@register("neighbour_impute", _with_daily(f"SELECT {', '.join(S.q(c) for c in _DAILY_COLS)} FROM neigh"))
def q_neighbour_impute(spark, sf):
    p = prep(spark, sf)
    return series.neighbour_impute(series.daily_series(p.normalized, decimals=9))


_DCONT = _CONT + _DISC  # daily means of clouds are continuous


@register("impute_location_month", _with_daily(
    f"SELECT {_by_fill_sql(_DAILY_COLS, _NORMAL, _DCONT, [])} FROM neigh LEFT JOIN "
    f"({_by_stats_sql('neigh', ['Location', 'Month'], _NORMAL, _DCONT, [])}) st USING (Location, Month)"))
def q_impute_location_month(spark, sf):
    p = prep(spark, sf)
    return series.impute_location_month(series.neighbour_impute(series.daily_series(p.normalized, decimals=9)), spec=SPEC)


_DIRS = list(SPEC.directions)
_POINTS = "[" + S.lit_list(DIRECTIONS) + "]"


def _angle(c):
    return f"(CASE WHEN list_position({_POINTS}, {S.q(c)}) > 0 THEN (list_position({_POINTS}, {S.q(c)}) - 1) * 22.5 END)"


def _ux(c):
    return f"sin(radians({_angle(c)}))"


def _uy(c):
    return f"cos(radians({_angle(c)}))"


def _vdir(x, y):
    deg = f"round(((degrees(atan2({x}, {y})) % 360.0) + 360.0) % 360.0, 6)"
    idx = f"((CAST(round({deg} / 22.5) AS INTEGER) % 16) + 16) % 16"
    return f"(CASE WHEN sqrt(({x}) * ({x}) + ({y}) * ({y})) >= 1e-9 THEN {_POINTS}[{idx} + 1] END)"


@register("direction_to_vector", P.chain(
    "SELECT h, " + ", ".join(f"round({_ux(c)}, 9) AS {S.q(c + '_ux')}, round({_uy(c)}, 9) AS {S.q(c + '_uy')}"
                            for c in _DIRS) + " FROM norm"))
def q_direction_to_vector(spark, sf):
    p = prep(spark, sf)
    return series.direction_vectors(p.normalized).select("h", *[f"{c}_{a}" for c in _DIRS for a in ("ux", "uy")])


_DDIR = ("ddir AS (SELECT Location, Date, " + ", ".join(
    f"sum({_ux(c)}) AS {S.q(c + '_sx')}, sum({_uy(c)}) AS {S.q(c + '_sy')}" for c in _DIRS)
    + ", CAST(month(Date) AS INTEGER) AS Month FROM norm WHERE Date IS NOT NULL GROUP BY Location, Date)")


def _circ(c):
    sx, sy = S.q(c + "_sx"), S.q(c + "_sy")
    px, py, nx, ny = (f"lag({sx}) {_W}", f"lag({sy}) {_W}", f"lead({sx}) {_W}", f"lead({sy}) {_W}")
    pl = f"(CASE WHEN sqrt({px} * {px} + {py} * {py}) >= 1e-9 THEN sqrt({px} * {px} + {py} * {py}) END)"
    nl = f"(CASE WHEN sqrt({nx} * {nx} + {ny} * {ny}) >= 1e-9 THEN sqrt({nx} * {nx} + {ny} * {ny}) END)"
    ux = f"(coalesce({px} / NULLIF({pl}, 0), 0.0) + coalesce({nx} / NULLIF({nl}, 0), 0.0))"
    uy = f"(coalesce({py} / NULLIF({pl}, 0), 0.0) + coalesce({ny} / NULLIF({nl}, 0), 0.0))"
    return f"coalesce({_vdir(sx, sy)}, {_vdir(ux, uy)}) AS {S.q(c)}"


_CIRC = f"circ AS (SELECT Location, Date, Month, {', '.join(_circ(c) for c in _DIRS)} FROM ddir)"


@register("circular_impute", S.with_obs("SELECT * FROM circ", *P.ctes(), _DDIR, _CIRC))
def q_circular_impute(spark, sf):
    p = prep(spark, sf)
    return series.circular_impute(p.normalized)


_MONTHLY = ("monthly AS (SELECT CAST(month(Date) AS INTEGER) AS Month, " + ", ".join(
    f"{_vdir('sum(' + _ux(c) + ')', 'sum(' + _uy(c) + ')')} AS {S.q(c + '_month')}" for c in _DIRS)
    + " FROM norm WHERE Date IS NOT NULL GROUP BY 1)")


@register("circular_month_fallback", S.with_obs(
    "SELECT Location, Date, Month, " + ", ".join(f"coalesce({S.q(c)}, {S.q(c + '_month')}) AS {S.q(c)}" for c in _DIRS)
    + " FROM circ LEFT JOIN monthly USING (Month)", *P.ctes(), _DDIR, _CIRC, _MONTHLY))
def q_circular_month_fallback(spark, sf):
    p = prep(spark, sf)
    return series.circular_month_fallback(series.circular_impute(p.normalized), p.normalized)


_EVAP_FENCE = ("ev AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
               "(SELECT quantile_disc(Evaporation, 0.25) AS q1, quantile_disc(Evaporation, 0.75) AS q3 FROM trf "
               "WHERE Evaporation IS NOT NULL AND NOT isnan(Evaporation)))")
_CLEAN = ("cf AS (SELECT trf.* FROM trf, ev WHERE coalesce(Cloud9am <> 9, true) AND coalesce(Cloud3pm <> 9, true) "
          "AND NOT coalesce(Evaporation < lo OR Evaporation > hi, false))")


@register("clean_final", S.with_obs(P.select_out("cf"), *P.ctes(), _EVAP_FENCE, _CLEAN))
def q_clean_final(spark, sf):
    p = prep(spark, sf)
    return transforms.clean_final(p.train_final)


@register("retention", S.with_obs("""
SELECT stage, n_rows, coalesce(lag(n_rows) OVER (ORDER BY pos) - n_rows, 0) AS n_dropped,
       round(CAST(n_rows AS DOUBLE) * 100.0 / lag(n_rows) OVER (ORDER BY pos), 6) AS pct_kept
FROM (SELECT 0 AS pos, 'input' AS stage, count(*) AS n_rows FROM obs
      UNION ALL SELECT 1, 'valid_label', count(*) FROM norm
      UNION ALL SELECT 2, 'train', count(*) FROM train
      UNION ALL SELECT 3, 'clean_final', count(*) FROM cf)""", *P.ctes(), _EVAP_FENCE, _CLEAN))
def q_retention(spark, sf):
    p = prep(spark, sf)
    return transforms.retention([("input", p.raw), ("valid_label", p.normalized), ("train", p.split[0]),
                                 ("clean_final", transforms.clean_final(p.train_final))])


@register("retention_written", ORACLE["retention"])
def q_retention_written(spark, sf):
    """The same numbers, counted as each stage is written."""
    p, seen = prep(spark, sf), transforms.Passage()
    p.raw = seen.write("input", p.raw)
    p._cache["normalized"] = seen.write("valid_label", p.normalized)
    p._cache["stored"] = (seen.write("train", p.split[0]), p.split[1])
    seen.write("clean_final", transforms.clean_final(p.train_final))
    return seen.table(spark)


_DM = {**ROW_MEANS, "Cloud_avg": ("Cloud9am", "Cloud3pm")}


@register("daily_means", P.chain(
    "SELECT h, " + ", ".join(f"round(({' + '.join(S.q(i) for i in ins)}) / {float(len(ins))}, 9) AS {S.q(o)}"
                            for o, ins in _DM.items()) + " FROM trf"))
def q_daily_means(spark, sf):
    return transforms.daily_means(prep(spark, sf).train_final).select("h", *_DM)


@register("cyclic_month", P.chain(
    "SELECT h, Month, round(sin(2 * pi() * (Month - 1) / 12), 9) AS Month_sin, "
    "round(cos(2 * pi() * (Month - 1) / 12), 9) AS Month_cos FROM norm"))
def q_cyclic_month(spark, sf):
    return transforms.with_cyclic_month(prep(spark, sf).normalized).select("h", "Month", "Month_sin", "Month_cos")


_FCOLS = ["Rainfall", *ROW_MEANS]
_FEAT_CTE = f"feat AS (SELECT h, Month, Rainfall, {_MEANS_SQL} FROM trf)"


def _feat_frame(p):
    """The model's columns of the final train side, stored: fitted on and then read."""
    return session.materialize(features.with_row_means(p.train_final).select("h", "Month", *_FCOLS))


_SPLITS = ("splits AS (SELECT " + ", ".join(
    f"list_distinct(quantile_disc({S.q(c)}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS {S.q(c)}" for c in _FCOLS)
    + " FROM feat)")


@register("quantile_bins", S.with_obs(
    "SELECT h, " + ", ".join(
        f"CAST(CASE WHEN f.{S.q(c)} IS NOT NULL THEN len(list_filter(s.{S.q(c)}, lambda x: x <= f.{S.q(c)})) END AS DOUBLE) "
        f"AS {S.q(c + '_bin')}" for c in _FCOLS) + " FROM feat f, splits s", *P.ctes(), _FEAT_CTE, _SPLITS))
def q_quantile_bins(spark, sf):
    f = _feat_frame(prep(spark, sf))
    return transforms.quantile_bins(f, transforms.quantile_splits(f, _FCOLS, stored=True)).select("h", *[c + "_bin" for c in _FCOLS])


@register("standardize", S.with_obs(
    "SELECT h, " + ", ".join(
        f"CASE WHEN s.{S.q(c + '_s')} IS NULL OR s.{S.q(c + '_s')} = 0 THEN (CASE WHEN f.{S.q(c)} IS NOT NULL THEN 0.0 END) "
        f"ELSE round((f.{S.q(c)} - s.{S.q(c + '_m')}) / s.{S.q(c + '_s')}, 9) END AS {S.q(c + '_std')}" for c in _FCOLS)
    + " FROM feat f, (SELECT " + ", ".join(f"avg({S.q(c)}) AS {S.q(c + '_m')}, stddev_samp({S.q(c)}) AS {S.q(c + '_s')}"
                                           for c in _FCOLS) + " FROM feat) s", *P.ctes(), _FEAT_CTE))
def q_standardize(spark, sf):
    f = _feat_frame(prep(spark, sf))
    return transforms.standardize(f, transforms.scaler_stats(f, _FCOLS)).select("h", *[c + "_std" for c in _FCOLS])


@register("model_sets")
def q_model_sets(spark, sf):
    p = prep(spark, sf)
    tr = _feat_frame(p)
    te = features.with_row_means(p.test_final)
    a, b = transforms.model_sets(tr, te, _FCOLS, stored=True)
    return b.select("h", "features_linear", "features_binned")


_LINEAR = ", ".join(
    f"CASE WHEN s.{S.q(c + '_s')} IS NULL OR s.{S.q(c + '_s')} = 0 THEN (CASE WHEN f.{S.q(c)} IS NOT NULL THEN 0.0 END) "
    f"ELSE round((f.{S.q(c)} - s.{S.q(c + '_m')}) / s.{S.q(c + '_s')}, 9) END AS linear_{i}" for i, c in enumerate(_FCOLS))
_SCALES = ", ".join(f"avg({S.q(c)}) AS {S.q(c + '_m')}, stddev_samp({S.q(c)}) AS {S.q(c + '_s')}" for c in _FCOLS)
_BINNED = ", ".join(f"CAST(CASE WHEN f.{S.q(c)} IS NOT NULL THEN len(list_filter(b.{S.q(c)}, lambda x: x <= f.{S.q(c)})) END AS DOUBLE) "
                    f"AS binned_{i}" for i, c in enumerate(_FCOLS))


@register("model_set_elements", S.with_obs(
    f"SELECT h, {_LINEAR}, round(sin(2 * pi() * (Month - 1) / 12), 9) AS linear_{len(_FCOLS)}, "
    f"round(cos(2 * pi() * (Month - 1) / 12), 9) AS linear_{len(_FCOLS) + 1}, "
    f"{_BINNED} FROM (SELECT h, Month, Rainfall, {_MEANS_SQL} FROM tef) f, (SELECT {_SCALES} FROM feat) s, splits b",
    *P.ctes(), _FEAT_CTE, _SPLITS))
def q_model_set_elements(spark, sf):
    """Both vectors of the test side by their elements; NaN stands for a missing one."""
    linear, binned = vector_to_array("features_linear"), vector_to_array("features_binned")
    return q_model_sets(spark, sf).select("h", *[F.nullif(linear[i], F.lit(float("nan"))).alias(f"linear_{i}") for i in range(len(_FCOLS) + 2)],
                                          *[F.nullif(binned[i], F.lit(float("nan"))).alias(f"binned_{i}") for i in range(len(_FCOLS))])


@register("impute_global", P.chain(
    "SELECT " + ", ".join(
        (f"coalesce({S.q(c)}, (SELECT quantile_disc({S.q(c)}, 0.5) FROM trc)) AS {S.q(c)}" if c in _NORMAL + _CONT else
         f"coalesce({S.q(c)}, (SELECT CAST(round(avg({S.q(c)})) AS INTEGER) FROM trc)) AS {S.q(c)}" if c in _DISC else
         f"coalesce({S.q(c)}, (SELECT value FROM (SELECT {S.q(c)} AS value, count(*) AS n FROM trc WHERE {S.q(c)} IS NOT NULL "
         f"GROUP BY 1 ORDER BY n DESC, value DESC LIMIT 1))) AS {S.q(c)}" if c in _DIRS else S.q(c))
        for c in P.OUT) + " FROM trc"))
def q_impute_global(spark, sf):
    p = prep(spark, sf)
    return impute.impute_global(p.train_clean, groupstats.global_stats(p.train_clean, stored=True))


# ---------------------------------------------------------------------------
# Table profile (S7) and unclassified test rows
# ---------------------------------------------------------------------------

_TYPE_NAMES = "CASE column_type WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' " \
              "WHEN 'BIGINT' THEN 'bigint' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END"


@register("table_profile", S.with_obs(f"""
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name, {_TYPE_NAMES} AS type,
       (SELECT count(*) FROM obs) AS n_rows, CAST(count(*) OVER () AS INTEGER) AS n_cols
FROM (DESCRIBE SELECT * FROM obs)"""))
def q_table_profile(spark, sf):
    return audit.table_profile(obs(spark, sf)).drop("nullable")  # DuckDB has another notion of it


@register("table_preview", S.with_obs("SELECT * FROM obs ORDER BY h, Date NULLS FIRST, Location NULLS FIRST LIMIT 5"))
def q_table_preview(spark, sf):
    return audit.preview(obs(spark, sf), 5, ["h", "Date", "Location"])


@register("unclassified_rate", S.with_obs(f"""
SELECT n_rows, n_unclassified, round(CAST(n_unclassified AS DOUBLE) * 100.0 / n_rows, 6) AS pct
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE {' OR '.join(S.q(c) + ' IS NULL' for c in _FCOLS)}) AS n_unclassified
      FROM (SELECT Rainfall, {_MEANS_SQL} FROM tef) t)""", *P.ctes()))
def q_unclassified_rate(spark, sf):
    p = prep(spark, sf)
    return transforms.unclassified_rate(features.with_row_means(p.test_final), _FCOLS)


# ---------------------------------------------------------------------------
# Readers and writers (S1-S3) and the typed cast
# ---------------------------------------------------------------------------

from ..functions.predicates import cast_columns  # noqa: E402
from ..session import shared_dir  # noqa: E402
from ..sources.tables import read_table, write_table  # noqa: E402


def _round_trip(spark, sf, table: str, fmt: str):
    source = read_table(spark, f"{sf}/{table}.parquet")
    path = write_table(source, f"{shared_dir(spark)}/round_trip_{fmt}_{uuid4().hex}", fmt)
    return read_table(spark, path, fmt, schema=source.schema)


@register("csv_round_trip", "SELECT * FROM customer")
def q_csv_round_trip(spark, sf):
    return _round_trip(spark, sf, "customer", "csv")


@register("parquet_round_trip", "SELECT * FROM orders")
def q_parquet_round_trip(spark, sf):
    return _round_trip(spark, sf, "orders", "parquet")


@register("cast_columns", """
SELECT c_custkey, TRY_CAST(c_acctbal AS DOUBLE) AS c_acctbal, TRY_CAST(c_name AS DOUBLE) AS c_name,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer""")
def q_cast_columns(spark, sf):
    text = read_table(spark, f"{sf}/customer.parquet").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_name",
        F.when(F.col("c_custkey") % 7 == 0, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey"))
    return cast_columns(text, {"c_acctbal": "double", "c_name": "double", "c_nationkey": "int"})
