"""What ends an Arrow batch in the passes of a selection, and how rows of group medians are sorted."""

from statistics import median_low

import pytest
from pyspark.sql import functions as F

from pluvio.operators import selection
from pluvio.operators.quantiles import sorted_medians
from pluvio.session import counted_batches

LIMIT, ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_passes_end_batches_by_rows(spark, monkeypatch, keys):
    monkeypatch.setattr(selection, "SAMPLE", 2_000)
    monkeypatch.setattr(selection, "FEW", 100)
    seen, limits = [], []
    of_task = selection._pass
    monkeypatch.setattr(selection, "_pass", lambda *a: (seen.append(1), of_task(*a))[1])
    inside = selection.counted_batches
    monkeypatch.setattr(selection, "counted_batches", lambda own: (limits.append(1), inside(own))[1])
    df = spark.range(40_000).selectExpr("if(id % 3 = 0, null, id % 3) k", "if(id % 5 = 0, null, double(id * 7919 % 30011)) x",
                                        "if(id % 7 = 0, double('NaN'), double(id % 11)) y", "double(null) z")
    found = selection.select_quantiles(df, ["x", "y", "z"], [0.25, 0.5], keys)
    assert len(limits) == len(seen) >= 3
    own = df.collect()
    for key, got in found.items():
        for c in "xy":
            values = sorted(r[c] for r in own if (not keys or r["k"] == key[0]) and r[c] is not None and r[c] == r[c])
            assert got[c] == [values[-(-len(values) // 4) - 1], values[-(-len(values) // 2) - 1]]
        assert got["z"] == [None, None]


def test_group_medians_sort_by_one_number(spark):
    # null keys leave a hash as it is: (null, a), (a, null) and (null, null) meet others of the same hash
    df = spark.range(9_000).selectExpr("element_at(array('a', 'b', null), int(id % 3 + 1)) a", "element_at(array('a', 'b', null), int(id * 7 % 11 % 3 + 1)) b",
                                       "if(id % 4 = 0, null, double(id * 31 % 1009)) x")
    same = df.select("a", "b", F.xxhash64("a", "b").alias("at")).distinct()
    assert same.count() > same.select("at").distinct().count()
    made = sorted_medians(df, ["a", "b"], ["x"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_hash" in plan and "ASC NULLS FIRST, " not in plan
    groups = {}
    for r in df.collect():
        groups.setdefault((r["a"], r["b"]), []).extend([r["x"]] if r["x"] is not None else [])
    got = [((r["a"], r["b"]), r["x"]) for r in made.collect()]
    assert len(got) == len(groups)
    assert dict(got) == {k: median_low(v) for k, v in groups.items()}


def test_batches_end_by_rows_only_inside(spark):
    before = spark.conf.get(LIMIT, None)
    with pytest.raises(ZeroDivisionError), counted_batches(spark):
        assert spark.conf.get(LIMIT) == str(2 ** 31 - 1)
        1 / 0
    assert spark.conf.get(LIMIT, None) == before
    rows = spark.conf.get(ROWS)
    spark.conf.set(ROWS, "0")
    try:
        with counted_batches(spark):
            assert spark.conf.get(LIMIT, None) == before
    finally:
        spark.conf.set(ROWS, rows)
