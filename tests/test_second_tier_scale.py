"""What a pass of the selection holds, how many passes it takes, and what the second tier and the final side store and read."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pluvio.functions.predicates import parse_date
from pluvio.operators import groupstats, selection
from pluvio.plans import catalog
from pluvio.plans.prepare import Preparation


def batches(n, rows=10_000):
    for i in range(n):
        value = np.random.default_rng(i).random(rows)
        value[0] = 2.0
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, "int32")), pa.array(value)], ["_g", "_v0"])


@pytest.mark.parametrize("ranges,picks", [({(0, 0): {(1.5, 2.5): 1.0}}, {}), ({}, {(0, 0): [(0, 1.5, 2.5)]})])
def test_a_pass_holds_what_it_keeps_and_not_its_batches(ranges, picks):
    run = selection._pass(ranges, {}, picks)
    tracemalloc.start()
    try:
        found = [r for b in run(batches(150)) for r in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [len(r["found"]) for r in found] == [150]
    assert peak < 4 << 20  # 150 batches of values are 12 MB


def passes(monkeypatch):
    seen = []
    run = selection._Selection._run
    monkeypatch.setattr(selection._Selection, "_run", lambda self, *a: (seen.append(1), run(self, *a))[1])
    return seen


def test_repeated_values_take_one_pass_after_the_sample(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 50)
    seen = passes(monkeypatch)
    df = spark.range(40_000).selectExpr("id % 2 k", "double(id * 7919 % 130) / 10 x", "double(id * 31 % 45) y", "double(id % 3) z")
    found = selection.select_quantiles(df, ["x", "y", "z"], [0.25, 0.5], ["k"])
    assert len(seen) == 2
    for k in (0, 1):
        own = [r for r in df.collect() if r["k"] == k]
        for c in "xyz":
            values = sorted(r[c] for r in own)
            assert found[k,][c] == [values[len(own) // 4 - 1], values[len(own) // 2 - 1]]


def test_distinct_values_take_one_pass_before_the_pick(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 2_000)
    monkeypatch.setattr(selection, "SAMPLE", 4_000)
    seen = passes(monkeypatch)
    df = spark.range(100_000).selectExpr("double(id * 48271 % 2147483647) x")
    found = selection.select_quantiles(df, ["x"], [0.1, 0.5])
    values = sorted(r[0] for r in df.collect())
    assert found[()]["x"] == [values[9_999], values[49_999]] and len(seen) == 2


def test_group_sizes_come_with_the_means(spark, monkeypatch):
    df = spark.range(60).selectExpr("id % 4 k", "if(id % 4 = 3, null, double(id)) x")
    want = sorted(map(tuple, groupstats.group_stats(df, ["k"], ["x"], ["x"], medians="exact").collect()))
    assert sorted(map(tuple, groupstats.group_stats(df, ["k"], ["x"], ["x"], medians="measured").collect())) == want
    monkeypatch.setattr(groupstats, "GROUP_ROWS", 5)
    spread = groupstats.group_stats(df, ["k"], ["x"], ["x"], medians="measured")
    assert sorted(map(tuple, spread.collect())) == want and "MapInArrow" not in spread._jdf.queryExecution().toString()


def test_stored_rows_without_values_are_in_no_median(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", None, 4.0), ("a", None, None), ("b", None, float("nan")), (None, 2.0, 2.0)], "k string, x double, y double")
    stats = [sorted(map(str, groupstats.group_stats(df, ["k"], ["x"], ["x", "y"], medians=m, stored=s).collect())) for m, s in (("exact", False), ("select", False), ("select", True))]
    assert stats[0] == stats[1] == stats[2] and len(stats[0]) == 2


def test_the_final_side_reads_stored_statistics_and_is_not_written(spark, obs_small):
    p = Preparation(obs_small, catalog.SPEC)
    once, again = p.train_final, p.train_final
    assert once is again
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Expand" not in plan  # nothing is fitted anew by a reader


def test_dates_of_the_plain_form_as_by_the_formatter(spark):
    texts = ["2024-01-31", "2024-02-30", "2024-13-01", "0000-01-01", "0999-12-31", "1582-10-10", "1500-02-29", "1900-02-29", "2000-02-29", "2024-1-5", " 2024-01-05", "2024-01-05 ",
             "2024-01-05T10", "2024", "", "x", None, "+2024-01-05", "12345-01-01", "+12345-01-01", "2024-01-00", "2024-01-05\n", "9999-12-31", "-2024-01-01"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    assert rows.filter(~parse_date("s").eqNullSafe(F.try_to_date("s", "yyyy-MM-dd"))).count() == 0


def test_global_statistics_of_stored_rows(spark, obs_small):
    p = Preparation(obs_small, catalog.SPEC)
    assert groupstats.global_stats(p.train_clean, stored=True) == groupstats.global_stats(p.train_clean)
