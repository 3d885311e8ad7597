"""Invariants of split, imputation, quantiles, prefix sums and models (sf0.001 obs)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.config import WEATHER
from pluvio.operators import groupstats, impute, metrics
from pluvio.operators.quantiles import exact_quantiles
from pluvio.operators.split import hash_split, split_label
from pluvio.plans.prepare import Preparation


@pytest.fixture(scope="module")
def prep(obs_small):
    return Preparation(obs_small)


def test_split_is_a_partition(prep):
    n = prep.normalized.count()
    tr, te = prep.split
    assert tr.count() + te.count() == n
    assert tr.join(te, "h", "left_semi").count() == 0
    assert split_label(prep.normalized).filter("split = 'train'").count() == tr.count()


def test_imputation_keeps_rows_and_present_values(prep):
    before = prep.train_clean
    after = prep.train_final
    assert after.count() == before.count()
    for c in WEATHER.numeric:
        b = before.select("h", F.col(c).alias("b")).groupBy("h").agg(F.collect_set("b").alias("b"))
        a = after.select("h", F.col(c).alias("a")).groupBy("h").agg(F.collect_set("a").alias("a"))
        changed = b.join(a, "h").filter(F.size("b") > 0).filter(~F.arrays_overlap("a", "b")).count()
        assert changed == 0, c


def test_global_fallback_leaves_no_nulls(prep):
    full = impute.impute_global(prep.train_clean, groupstats.global_stats(prep.train_clean))
    for c in [*WEATHER.numeric, *WEATHER.directions]:
        assert full.filter(F.col(c).isNull()).count() == 0, c


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(7)
    vals = [(g, float(rng.randint(0, 300))) for g in ("a", "b") for _ in range(997)]
    df = spark.createDataFrame(vals, "g string, x double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r.g: r.q for r in exact_quantiles(df, ["g"], "x", probs, buckets=8).collect()}
    for g in ("a", "b"):
        xs = np.sort([v for k, v in vals if k == g])
        want = [xs[max(int(np.ceil(p * len(xs))), 1) - 1] for p in probs]
        assert got[g] == want


def test_prefix_sums_match_cumsum(spark):
    rng = random.Random(3)
    rows = [(rng.random(), rng.randint(0, 5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s double, v long").groupBy("s").agg(F.sum("v").alias("v"))
    out = metrics.descending_prefix(df, "s", ["v"], buckets=7).toPandas().sort_values("s", ascending=False)
    assert (out["cum_v"].values == out["v"].cumsum().values).all()
    assert (out["tot_v"] == out["v"].sum()).all()


def test_confusion_sums_and_auc_range(spark):
    df = spark.createDataFrame([(float(i % 2), float((i * 7) % 3 == 0), (i % 17) / 17.0) for i in range(500)],
                               "label double, prediction double, score double")
    assert sum(r.n for r in metrics.confusion(df).collect()) == 500
    auc = metrics.auc_roc(df, "score").first()[0]
    assert 0.0 <= auc <= 1.0


def test_hash_split_is_stable(prep):
    a = hash_split(prep.normalized)[0].select("h").distinct()
    b = hash_split(prep.normalized.repartition(5))[0].select("h").distinct()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stratified_split_partitions_each_class(prep):
    from pluvio.operators.split import stratified_split
    n = prep.normalized
    tr, te = stratified_split(n)
    assert tr.count() + te.count() == n.count()
    for v in ("Yes", "No"):
        total = n.filter(F.col("RainTomorrow") == v).count()
        share = tr.filter(F.col("RainTomorrow") == v).count() / total
        assert 0.7 < share < 0.9, (v, share)


def test_xxhash_split_is_a_partition(prep):
    tr, te = hash_split(prep.normalized, method="xxhash64")
    assert tr.count() + te.count() == prep.normalized.count()
    assert 0.7 < tr.count() / prep.normalized.count() < 0.9
