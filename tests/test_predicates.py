"""Golden unit cases for the column predicates and normalisers."""

import math

from pyspark.sql import functions as F

from pluvio.config import AUDIT_TOKENS, WIND_TOKENS
from pluvio.functions.predicates import (canonical_binary, is_missing, is_token, missing_in, normalize_tokens,
                                         parse_date, threshold_flag)


def test_missing_tokens_text(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", " NA ", "nan", "Null", "n/a", "none", "MISSING", "x", "0"]],
                               "v string")
    got = [r[0] for r in df.select(is_missing("v", AUDIT_TOKENS, "string")).collect()]
    assert got == [True] * 8 + [False, False]


def test_missing_numeric_fast_path_equals_text_path(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (0.0,)], "x double")
    fast = [r[0] for r in df.select(missing_in(df, "x")).collect()]
    slow = [r[0] for r in df.select(is_missing("x", AUDIT_TOKENS, None)).collect()]
    assert fast == slow == [False, True, True, False]


def test_numeric_token_disables_fast_path(spark):
    df = spark.createDataFrame([(0,), (1,)], "x int")
    got = [r[0] for r in df.select(is_missing("x", ("0",), "int")).collect()]
    assert got == [True, False]
    assert [r[0] for r in df.select(is_token("x", ("1",), "int")).collect()] == [False, True]


def test_wind_normalisation_and_binary(spark):
    df = spark.createDataFrame([(" nne ", "yes"), ("?", "NO"), ("-", "maybe"), (None, None)], "d string, b string")
    rows = df.select(normalize_tokens("d", WIND_TOKENS).alias("d"), canonical_binary("b").alias("b")).collect()
    assert [(r.d, r.b) for r in rows] == [("NNE", "Yes"), (None, "No"), (None, "maybe"), (None, None)]


def test_parse_date_is_tolerant(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-13-01",), ("junk",), (None,)], "d string")
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert str(got[0]) == "2024-01-31" and got[1:] == [None, None, None]


def test_threshold_flag_null_is_no(spark):
    df = spark.createDataFrame([(0.0,), (0.2,), (None,)], "r double")
    assert [r[0] for r in df.select(threshold_flag("r")).collect()] == ["No", "Yes", "No"]
    assert not math.isnan(0.0)
    assert df.select(F.count("*")).first()[0] == 3
