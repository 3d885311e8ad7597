"""Registered queries against their DuckDB SQL on the small driver tables.

The driver checks every query at sf0.01; here a representative subset
(one per operator family) runs at sf0.001 so the suite stays quick. Run
``python tools/oracle_check.py`` for the full comparison.
"""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SUBSET = ["missing_profile", "quality_report", "missing_cooccurrence", "domain_violations", "top_duplicates",
          "numeric_summary", "percentiles", "top_k", "corr_matrix", "rate_by_top_location",
          "iqr_bounds", "group_modes", "impute_raintoday_test", "prepare_test",
          "roc_curve", "auc_pr", "weighted_rates", "neighbour_impute", "circular_month_fallback", "quantile_bins"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_sql(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    sc, sr = rows_of(sdf.toPandas(), 9)
    dc, dr = rows_of(duck.execute(E.oracle_sql()[name]).df(), 9)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_query_has_oracle_or_is_a_model():
    from pluvio.plans.catalog import ORACLE, QUERIES
    q, o = QUERIES, ORACLE
    assert set(o) <= set(q)
    assert set(q) - set(o) <= {"fit_tree", "fit_forest", "cross_validate", "tune_two_stage", "tune_forest", "score",
                               "score_label", "score_by_nodes", "evaluate_tree", "evaluate_forest", "model_sets"}
