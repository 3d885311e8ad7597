"""Exact quantiles by selection, stored stages and their release."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import selection
from pluvio.operators.groupstats import group_stats
from pluvio.operators.selection import select_quantiles
from pluvio.session import ensure_checkpoint_dir, materialize, stages

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def brute(values, probs):
    own = sorted(v for v in values if v is not None and not math.isnan(v))
    return [own[max(1, math.ceil(p * len(own))) - 1] if own else None for p in probs]


def odd_rows():
    rng = random.Random(4)
    rows = []
    for i in range(4000):
        key = rng.choice(["a", "a", "a", "b", None])
        wild = rng.choice([1, -1]) * 10.0 ** rng.randrange(-300, 300)
        rows.append((key, rng.gauss(0, 1), float(rng.randrange(3)), wild, 7.0, rng.choice([None, float("nan"), float("inf"), -0.0, 1e9 + i])))
    return rows + [("c", None, None, float("nan"), 1.0, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), "k string, x double, d double, w double, one double, n double").repartition(7).cache()


@pytest.mark.parametrize("few,sample", [(20_000, 800_000), (3, 60), (1, 2000)])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_selection_is_exact_whatever_the_samples_are(odd, monkeypatch, few, sample, keys):
    monkeypatch.setattr(selection, "FEW", few)
    monkeypatch.setattr(selection, "SAMPLE", sample)
    monkeypatch.setattr(selection, "LEAST", 5)
    cols = ["x", "d", "w", "one", "n"]
    got = select_quantiles(odd, cols, PROBS, keys)
    rows = odd_rows()
    groups = {(k,) for k, *_ in rows} if keys else {()}
    assert set(got) == groups
    for key in groups:
        own = [r[1:] for r in rows if not keys or (r[0],) == key]
        assert got[key] == {c: brute([r[i] for r in own], PROBS) for i, c in enumerate(cols)}


def test_selection_of_nothing(odd):
    assert select_quantiles(odd.filter("false"), ["x"], [0.5], ["k"]) == {}
    assert select_quantiles(odd.filter("false"), ["x"], [0.5]) == {(): {"x": [None]}}


def test_too_many_groups_are_an_error(spark):
    with pytest.raises(ValueError, match="groups"):
        select_quantiles(spark.range(selection.MAX_GROUPS + 1).selectExpr("id", "double(id) x"), ["x"], [0.5], ["id"])


def test_selection_neither_multiplies_rows_nor_shuffles_values(odd):
    source = odd.select((F.col("x")).alias("_v0"))
    plan = source.mapInArrow(selection._pass({(None, 0): {(-math.inf, math.inf): 0.1}}, {}, {}), selection._SCHEMA)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text.split("InMemoryTableScan")[0] and "Expand" not in text and "Generate" not in text


@pytest.mark.parametrize("way", ["exact", "exact_spread", "select", "measured"])
def test_medians_are_the_same_in_every_way(odd, way):
    got = {r["k"]: (r["x_mean"], r["x_median"], r["n_median"]) for r in group_stats(odd, ["k"], mean_cols=["x"], median_cols=["x", "n"], medians=way).collect()}
    for k, (_, x, n) in got.items():
        own = [r for r in odd_rows() if r[0] == k]
        assert (x, n) == (brute([r[1] for r in own], [0.5])[0], brute([r[5] for r in own], [0.5])[0])


def stored(spark):
    folder = ensure_checkpoint_dir(spark, allow_local=True).removeprefix("file:")
    return {x for x in os.listdir(folder) if x.startswith("pluvio-stage-")}


def test_a_scope_releases_its_stages_on_errors_too(spark):
    before = stored(spark)
    with stages():
        outer = materialize(spark.range(10))
        with stages():
            assert materialize(spark.range(5)).count() == 5 and len(stored(spark) - before) == 2
        assert outer.count() == 10 and len(stored(spark) - before) == 1
        with pytest.raises(ZeroDivisionError), stages():
            materialize(spark.range(3))
            1 / 0
    assert stored(spark) == before


def test_no_stage_is_left_after_a_query_in_a_scope(spark):
    from pluvio.plans.catalog import QUERIES
    before = stored(spark)
    with stages():
        assert QUERIES["iqr_bounds"](spark, "/root/testdata/sf0.001").count() == 7
        assert stored(spark) > before
    assert stored(spark) == before


def test_stages_are_read_by_column(spark):
    plan = materialize(spark.range(5).selectExpr("id a", "id b", "id c")).select("b").filter("b > 2")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:bigint>" in plan and "PushedFilters: [IsNotNull(b), GreaterThan(b,2)]" in plan
