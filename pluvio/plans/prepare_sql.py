"""DuckDB oracle text for the preparation cascade (mirrors plans.prepare)."""

from __future__ import annotations

from ..config import AUDIT_TOKENS, WEATHER, WIND_TOKENS
from . import sqltext as S

SPEC = WEATHER
COLS = list(SPEC.columns)
OUT = [*COLS, "h", "Month", "DayMonth"]
K3 = ["Location", "DayMonth", "RainTomorrow"]
K2 = ["Location", "DayMonth"]
WIND = list(SPEC.directions)
NORMAL = list(SPEC.normal)
CONT = list(SPEC.continuous)
DISC = list(SPEC.discrete)
NUMERIC = list(SPEC.numeric)
q = S.q


def _norm_cte() -> str:
    sel = []
    for c in COLS:
        if c == "Date":
            sel.append("CAST(try_strptime(Date, '%Y-%m-%d') AS DATE) AS Date")
        elif c == "RainTomorrow":
            sel.append("CASE WHEN lower(trim(RainTomorrow)) = 'yes' THEN 'Yes' "
                       "WHEN lower(trim(RainTomorrow)) = 'no' THEN 'No' ELSE RainTomorrow END AS RainTomorrow")
        elif c in WIND:
            sel.append(f"CASE WHEN upper(trim({q(c)})) IN ({S.lit_list(WIND_TOKENS)}) THEN NULL "
                       f"ELSE upper(trim({q(c)})) END AS {q(c)}")
        else:
            sel.append(q(c))
    inner = f"SELECT {', '.join(sel)}, h FROM obs"
    return (f"norm AS (SELECT *, CAST(month(Date) AS INTEGER) AS Month, strftime(Date, '%d%m') AS DayMonth "
            f"FROM ({inner}) n WHERE RainTomorrow IN ('Yes', 'No'))")


BUCKET = "(('0x' || substr(md5(CAST(h AS VARCHAR)), 1, 8))::BIGINT % 10)"
FOLD = "(('0x' || substr(md5(CAST(h AS VARCHAR)), 9, 8))::BIGINT % {k})"

OUTLIERS = list(SPEC.outliers)


def _bounds_cte() -> str:
    parts = S.union_all(
        f"SELECT '{c}' AS column_name, quantile_disc({q(c)}, 0.25) AS q1, quantile_disc({q(c)}, 0.75) AS q3 "
        f"FROM train WHERE {q(c)} IS NOT NULL AND NOT isnan({q(c)}) HAVING count({q(c)}) > 0" for c in OUTLIERS)
    return (f"bounds AS (SELECT column_name, CAST(q1 AS DOUBLE) AS q1, CAST(q3 AS DOUBLE) AS q3, "
            f"q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM ({parts}) b)")


def _clean_cte(name: str, src: str) -> str:
    wide = ", ".join(
        f"max(CASE WHEN column_name = '{c}' THEN lower END) AS {q('lo_' + c)}, "
        f"max(CASE WHEN column_name = '{c}' THEN upper END) AS {q('hi_' + c)}" for c in OUTLIERS)
    sel = []
    for c in OUT:
        if c in OUTLIERS:
            sel.append(f"CASE WHEN {q(c)} < {q('lo_' + c)} OR {q(c)} > {q('hi_' + c)} THEN NULL ELSE {q(c)} END AS {q(c)}")
        else:
            sel.append(q(c))
    return f"{name} AS (SELECT {', '.join(sel)} FROM {src} CROSS JOIN (SELECT {wide} FROM bounds) bw)"


def _any_numeric() -> str:
    return "(" + " OR ".join(f"{q(c)} IS NOT NULL" for c in NUMERIC) + ")"


def _stats1_cte(name: str, src: str, keys: list[str]) -> str:
    aggs = [f"round(avg({q(c)}), 9) AS {q(c + '_mean')}" for c in NORMAL]
    aggs += [f"quantile_disc({q(c)}, 0.5) AS {q(c + '_median')}" for c in CONT]
    aggs += [f"avg({q(c)}) AS {q(c + '_mean')}" for c in DISC]
    k = ", ".join(q(x) for x in keys)
    return f"{name} AS (SELECT {k}, {', '.join(aggs)} FROM {src} WHERE {_any_numeric()} GROUP BY {k})"


def _modes_cte(name: str, src: str, keys: list[str], cols: list[str], present: str) -> str:
    """Most frequent present value per group and column; ties → largest value."""
    k = ", ".join(q(x) for x in keys)
    unp = (f"UNPIVOT (SELECT {k}, {', '.join('CAST(' + q(c) + ' AS VARCHAR) AS ' + q(c) for c in cols)} FROM {src}) "
           f"ON {', '.join(q(c) for c in cols)} INTO NAME column_name VALUE value")
    counts = f"SELECT {k}, column_name, value, count(*) AS cnt FROM ({unp}) u WHERE {present} GROUP BY ALL"
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {k}, column_name ORDER BY cnt DESC, value DESC) AS rk "
              f"FROM ({counts}) c")
    piv = ", ".join(f"max(CASE WHEN column_name = '{c}' THEN value END) AS {q(c + '_mode')}" for c in cols)
    return f"{name} AS (SELECT {k}, {piv} FROM ({ranked}) r WHERE rk = 1 GROUP BY {k})"


def _present(col: str = "value") -> str:
    return f"NOT {S.missing(col, AUDIT_TOKENS)}"


def _numeric_fill(c: str) -> str:
    if c in NORMAL:
        return f"CASE WHEN {q(c)} IS NULL THEN {q(c + '_mean')} ELSE {q(c)} END AS {q(c)}"
    if c in DISC:
        return (f"CASE WHEN {q(c)} IS NULL THEN CAST(round(coalesce({q(c + '_mean')}, 0.0)) AS INTEGER) "
                f"ELSE {q(c)} END AS {q(c)}")
    if c in CONT:
        return f"CASE WHEN {q(c)} IS NULL THEN {q(c + '_median')} ELSE {q(c)} END AS {q(c)}"
    return q(c)


def _wind_fill(c: str) -> str:
    if c in WIND:
        return f"CASE WHEN {S.missing(c, AUDIT_TOKENS)} THEN {q(c + '_mode')} ELSE {q(c)} END AS {q(c)}"
    return q(c)


def _using(keys):
    return "USING (" + ", ".join(q(k) for k in keys) + ")"


def ctes() -> list[str]:
    """All stages as CTEs after ``obs``; unused ones cost nothing in DuckDB."""
    out = [
        _norm_cte(),
        f"train AS (SELECT * FROM norm WHERE {BUCKET} < 8)",
        f"test AS (SELECT * FROM norm WHERE {BUCKET} >= 8)",
        _bounds_cte(),
        _clean_cte("trc", "train"),
        _clean_cte("tec", "test"),
        _stats1_cte("st3", "trc", K3),
        _stats1_cte("st2", "trc", K2),
        _modes_cte("md3", "trc", K3, WIND, _present()),
        _modes_cte("md2", "trc", K2, WIND, _present()),
        _modes_cte("rm", "(SELECT RainTomorrow, upper(trim(RainToday)) AS RainToday FROM trc)", ["RainTomorrow"],
                   ["RainToday"], _present()),
    ]
    # Tier-1 numeric, RainToday, wind (train: 3 keys + label mode; test: 2 keys + rule).
    num3 = ", ".join(_numeric_fill(c) for c in OUT)
    num2 = num3
    out.append(f"trn AS (SELECT {num3} FROM trc LEFT JOIN st3 {_using(K3)})")
    out.append(f"ten AS (SELECT {num2} FROM tec LEFT JOIN st2 {_using(K2)})")
    rt_train = (f"CASE WHEN {S.missing('RainToday', AUDIT_TOKENS)} THEN RainToday_mode ELSE RainToday END AS RainToday")
    sel_rt = ", ".join(rt_train if c == "RainToday" else q(c) for c in OUT)
    out.append(f"trr AS (SELECT {sel_rt} FROM (SELECT * REPLACE (upper(trim(RainToday)) AS RainToday) FROM trn) x "
               f"LEFT JOIN rm USING (RainTomorrow))")
    rt_test = (f"CASE WHEN {S.missing('RainToday', AUDIT_TOKENS)} THEN "
               f"(CASE WHEN Rainfall > 0.0 THEN 'Yes' ELSE 'No' END) ELSE RainToday END AS RainToday")
    sel_rt2 = ", ".join(rt_test if c == "RainToday" else q(c) for c in OUT)
    out.append(f"ter AS (SELECT {sel_rt2} FROM (SELECT * REPLACE (upper(trim(RainToday)) AS RainToday) FROM ten) x)")
    wsel = ", ".join(_wind_fill(c) for c in OUT)
    out.append(f"tr1 AS (SELECT {wsel} FROM trr LEFT JOIN md3 {_using(K3)})")
    out.append(f"te1 AS (SELECT {wsel} FROM ter LEFT JOIN md2 {_using(K2)})")
    # Tier 2.
    flag = "CASE WHEN Rainfall > 0.0 THEN 'Yes' ELSE 'No' END"
    out.append(_stats2_cte("s2l", "tr1", "RainTomorrow"))
    out.append(_modes_cte("m2l", "tr1", ["RainTomorrow"], WIND, "value IS NOT NULL"))
    out.append(_stats2_cte("s2f", f"(SELECT *, {flag} AS RainToday_inferred FROM tr1)", "RainToday_inferred"))
    out.append(_modes_cte("m2f", f"(SELECT *, {flag} AS RainToday_inferred FROM tr1)", ["RainToday_inferred"], WIND,
                          "value IS NOT NULL"))
    fill2 = ", ".join(_tier2_fill(c) for c in OUT)
    out.append(f"tr2 AS (SELECT {fill2} FROM tr1 LEFT JOIN s2l USING (RainTomorrow) LEFT JOIN m2l USING (RainTomorrow))")
    out.append(f"te2 AS (SELECT {fill2} FROM (SELECT *, {flag} AS RainToday_inferred FROM te1) t "
               f"LEFT JOIN s2f USING (RainToday_inferred) LEFT JOIN m2f USING (RainToday_inferred))")
    canon = ("CASE WHEN lower(trim(RainToday)) = 'yes' THEN 'Yes' WHEN lower(trim(RainToday)) = 'no' THEN 'No' "
             "ELSE RainToday END AS RainToday")
    csel = ", ".join(canon if c == "RainToday" else q(c) for c in OUT)
    out.append(f"trf AS (SELECT {csel} FROM tr2)")
    out.append(f"tef AS (SELECT {csel} FROM te2)")
    return out


def _stats2_cte(name: str, src: str, key: str) -> str:
    aggs = [f"quantile_disc({q(c)}, 0.5) AS {q(c + '_median')}" for c in [*NORMAL, *CONT]]
    aggs += [f"avg({q(c)}) AS {q(c + '_mean')}" for c in DISC]
    return f"{name} AS (SELECT {q(key)}, {', '.join(aggs)} FROM {src} s WHERE {_any_numeric()} GROUP BY {q(key)})"


def _tier2_fill(c: str) -> str:
    if c in NORMAL or c in CONT:
        return f"CASE WHEN {q(c)} IS NULL THEN {q(c + '_median')} ELSE {q(c)} END AS {q(c)}"
    if c in DISC:
        return (f"CASE WHEN {q(c)} IS NULL THEN CAST(round(coalesce({q(c + '_mean')}, 0.0)) AS INTEGER) "
                f"ELSE {q(c)} END AS {q(c)}")
    if c in WIND:
        return f"CASE WHEN {q(c)} IS NULL THEN {q(c + '_mode')} ELSE {q(c)} END AS {q(c)}"
    return q(c)


def chain(body: str) -> str:
    return S.with_obs(body, *ctes())


def select_out(src: str) -> str:
    return f"SELECT {', '.join(q(c) for c in OUT)} FROM {src}"
