"""Exact order statistics from value counts and distributed prefix sums.

For probability p over n values the result is the smallest value whose
cumulative count reaches ceil(p·n) (the discrete percentile). Rows are
first reduced to (group, value, count) with map-side combining; these are
dealt out by ranges of group and value, as many as their number asks for, and
the cumulative counts are computed per group and range plus the prefix of the
group's range totals. So neither a hot group nor a high-cardinality column ever
lands in a single window partition, memory stays bounded, unlike a hash map of
all values, and cost stays linear, unlike a 1e-6-accuracy GK sketch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


#: Counted values in a range.
PER_RANGE = 100_000


def exact_quantiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    out: str = "q", buckets: int | None = None) -> DataFrame:
    """keys + ``out`` (array, one entry per probability) over non-null, non-NaN values; a null key is a group.

    ``buckets`` is the number of ranges of the whole table, by default one for PER_RANGE counted values.
    """
    keys = list(keys)
    v = F.col(value)
    # The (group, value, count) table holds distinct values only; it is
    # materialised once for its size, and once as dealt out.
    counts = materialize(long.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, value)
                             .agg(F.count(F.lit(1)).alias("cnt")))
    ranges = buckets or max(1, -(-counts.count() // PER_RANGE))
    b = materialize(counts.repartitionByRange(ranges, *keys, value).withColumn("bucket", F.spark_partition_id()))
    w_local = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("loc", F.sum("cnt").over(w_local))
    totals = b.groupBy(*keys, "bucket").agg(F.sum("cnt").alias("bt"))
    # One row per range of the group in these windows.
    w_off = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("bucket").alias("__bucket"),
                            F.coalesce(F.sum("bt").over(w_off), F.lit(0)).alias("off"),
                            F.sum("bt").over(Window.partitionBy(*keys)).alias("n"))
    same = F.col("bucket") == F.col("__bucket")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    cum = local.join(offsets, same).withColumn("cum", F.col("loc") + F.col("off"))
    aggs = []
    for i, p in enumerate(probs):
        rank = F.greatest(F.ceil(F.lit(float(p)) * F.col("n")), F.lit(1))
        aggs.append(F.min(F.when(F.col("cum") >= rank, v)).alias(f"__q{i}"))
    res = cum.groupBy(*keys).agg(*aggs)
    return res.select(*keys, F.array(*[F.col(f"__q{i}") for i in range(len(probs))]).alias(out))


def sorted_medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """keys + one double per column: the discrete median (rank ceil(n / 2)) of each group's values; null and NaN are missing, a null key is a group.

    Rows are shuffled and sorted by a hash of the keys alone, one number, which Spark sorts by radix; a task walks through them in
    Arrow batches and holds the rows of one hash and a batch at a time, so groups must be bounded. Groups are told apart by
    the keys themselves, also where their hashes are equal; those that end in a batch are taken together.
    """
    keys, cols = list(keys), list(cols)
    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    dealt = rows.withColumn("_hash", F.xxhash64(*keys)).repartition("_hash").sortWithinPartitions("_hash")
    made = dealt.mapInArrow(_medians(len(keys), len(cols)), _median_schema(rows, keys, len(cols)))
    return made.select(*keys, *[F.col(f"_v{i}").alias(c) for i, c in enumerate(cols)])


def _median_schema(rows: DataFrame, keys: Sequence[str], n: int) -> str:
    return ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys), *(f"_v{i} double" for i in range(n))])


def _medians(n_keys: int, n_values: int):
    """A task's medians over batches of keys, values and a hash of the keys, sorted by the hash; the last hash of a batch waits for the next."""

    def heads(table: pa.Table) -> np.ndarray:
        """First row of each hash."""
        at = table.column(n_keys + n_values).to_numpy()
        return np.flatnonzero(np.append(len(at) > 0, at[1:] != at[:-1]))

    def taken(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.zeros(len(table), np.int64)
        for k in range(n_keys):
            code = table.column(k).combine_chunks().dictionary_encode("encode")
            # numbered anew for each key, so that no product of them grows too large
            _, first, group = np.unique(group * max(1, len(code.dictionary)) + code.indices.to_numpy(zero_copy_only=False),
                                        return_index=True, return_inverse=True)
        out = []
        for i in range(n_keys, n_keys + n_values):
            value = table.column(i).to_numpy()
            keep = ~np.isnan(value)
            own, value = group[keep], value[keep]
            value = value[np.lexsort((value, own))]
            n = np.bincount(own, minlength=len(first))
            at = np.cumsum(n) - n + np.maximum(n - 1, 0) // 2
            median = value[np.minimum(at, len(value) - 1)] if len(value) else np.zeros(len(first))
            out.append(pa.array(median, mask=n == 0))
        held = table.select(range(n_keys)).take(first).combine_chunks()
        yield from pa.table([*held.columns, *out], names=table.column_names[:-1]).to_batches(10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # a group that goes on through whole batches is only looked through once it ends
            if waiting and not len(heads(pa.Table.from_batches([waiting[0].slice(0, 1), batch]))) > 1:
                waiting.append(batch)
                continue
            table = pa.Table.from_batches([*waiting, batch])
            first = heads(table)
            if len(first) > 1:
                yield from taken(table.slice(0, int(first[-1])))
            waiting = table.slice(int(first[-1])).combine_chunks().to_batches()
        if waiting:
            yield from taken(pa.Table.from_batches(waiting))
    return run
