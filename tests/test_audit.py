"""Audit operators on tiny inline frames, plus plan checks."""

from pyspark.sql import functions as F

from pluvio.config import Roles
from pluvio.operators import audit

SPEC = Roles(columns=("a", "b", "c"), date="d", ranges={"a": (0.0, 10.0)})


def frame(spark):
    rows = [(1.0, "x", "NA", "2024-01-01"), (None, "y", "ok", "2024-13-01"), (1.0, "x", "NA", "2024-01-01"),
            (20.0, None, None, None), (5.0, "z", "ok", "2024-02-30")]
    return spark.createDataFrame(rows, "a double, b string, c string, d string")


def test_missing_profile_and_completeness(spark):
    df = frame(spark)
    got = {r.column_name: r.n_missing for r in audit.missing_profile(df, spec=SPEC).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}
    c = audit.completeness(df, spec=SPEC).first()
    assert (c.n_rows, c.n_complete, c.n_incomplete) == (5, 1, 4)


def test_duplicates_and_score(spark):
    df = frame(spark)
    d = audit.duplicate_summary(df, cols=["a", "b", "c", "d"]).first()
    assert (d.n_rows, d.n_distinct, d.n_duplicates) == (5, 4, 1)
    s = audit.quality_score(df, cols=["a", "b", "c"]).first()
    assert abs(s.score - 20.0 * (1 - 1 / 5)) < 1e-9


def test_digest_tells_rows_apart_as_grouping_does(spark):
    nan = float("nan")
    rows = [(None, "x", 0.0), ("x", None, 0.0), (None, None, None), ("x", "", -0.0), ("", "x", 0.0), ("x", "", 0.0), (None, "x", -0.0),
            ("a", "bc", nan), ("ab", "c", nan), ("a", "bc", nan), ("", None, 1.0), (None, "", 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    groups = df.groupBy("a", "b", "c").count()
    d = audit.duplicate_summary(df, cols=["a", "b", "c"]).first()
    assert (d.n_rows, d.n_distinct) == (len(rows), groups.count())
    top = audit.top_duplicates(df, k=9, cols=["a", "b", "c"], show=["a", "b"]).collect()
    want = sorted((r["count"], r.a or "", r.b or "") for r in groups.filter("count > 1").collect())
    assert sorted((r.n_copies, r.a or "", r.b or "") for r in top) == want


def test_counters_over_more_columns_than_a_mask_holds(spark):
    names = [f"c{i}" for i in range(130)]
    rows = [[None if i % 7 == r else float(i) for i in range(130)] for r in (0, 1, 1, 9)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).withColumn("d", F.lit("2024-01-01"))
    spec = Roles(columns=tuple(names), date="d", ranges={"c3": (0.0, 2.0), "c128": (0.0, 128.0)})
    c = audit.audit_counters(df, spec).first()
    assert (c.n_rows, c.n_distinct, c.n_complete, c.n_invalid_dates, c.range__c3, c.range__c128) == (4, 3, 1, 0, 4, 0)
    assert [c[f"miss__{n}"] for n in names] == [{0: 1, 1: 2}.get(i % 7, 0) for i in range(130)]


def test_ranges_dates_domains(spark):
    df = frame(spark)
    r = {x.column_name: x.n_out for x in audit.range_violations(df, spec=SPEC).collect()}
    assert r == {"a": 1}
    span = audit.date_span(df, "d").first()
    assert span.n_invalid == 2 and str(span.first_date) == "2024-01-01"
    dv = {(x.column_name, x.value): x.n_rows for x in audit.domain_violations(df, {"c": ["ok"]}).collect()}
    assert dv == {("c", "NA"): 2}


def test_cooccurrence_reports_zero_pairs(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (1.0, None, 1.0), (1.0, 1.0, None)], "p double, q double, r double")
    got = {(x.col_a, x.col_b): x.n_both for x in audit.missing_cooccurrence(df, k=3, cols=["p", "q", "r"]).collect()}
    assert got == {("p", "q"): 0, ("p", "r"): 0, ("q", "r"): 0}


def test_report_has_no_python_and_one_shuffle_family(obs_small):
    plan = audit.quality_report(obs_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    # lineitem is read once: the report is one scan + the duplicate grouping.
    assert plan.count("lineitem") <= 2  # the exchange may be reused once


def test_residual_missing_filters_clean_columns(spark):
    df = spark.createDataFrame([("a", None), ("-", 1.0)], "s string, x double")
    got = {(r.column_name, r.n_null, r.n_token) for r in audit.residual_missing(df).collect()}
    assert got == {("s", 0, 1), ("x", 1, 0)}
    assert df.select(F.count("*")).first()[0] == 2


def test_cooccurrence_beyond_one_mask(spark):
    cols = [f"c{i}" for i in range(70)]
    rows = [tuple(None if (i == r or i == 65) else 1.0 for i in range(70)) for r in (0, 1, 64)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {(x.col_a, x.col_b): x.n_both for x in audit.missing_cooccurrence(df, k=2, cols=cols).collect()}
    assert got == {("c65", "c0"): 1}
