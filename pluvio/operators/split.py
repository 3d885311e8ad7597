"""Reproducible train/test splits and fold assignment."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import WEATHER, Roles
from ..session import materialize
from .selection import select_quantiles


def hash_bucket(key_cols: Sequence[str], n: int, part: int = 0, method: str = "md5") -> Column:
    """Bucket in [0, n) from 32 bits of the md5 of the key text.

    ``part`` picks which 8 hex digits of the digest are used, so a second,
    independent bucketing (e.g. folds inside the train side) is available
    from the same key. md5 is the default because SQL engines compute it
    identically (so splits can be reproduced outside Spark);
    ``method="xxhash64"`` is about 3x cheaper per row and Spark-only.
    """
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(part)), F.lit(n))
    if len(key_cols) == 1:
        text = F.col(key_cols[0]).cast("string")
    else:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    hexpart = F.substring(F.md5(text), 1 + 8 * part, 8)
    return F.conv(hexpart, 16, 10).cast("bigint") % n


def hash_split(df: DataFrame, key_cols: Sequence[str] | None = None, ratio: float = 0.8,
               buckets: int = 10, spec: Roles = WEATHER, method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row key: same rows on any partitioning.

    Rows sharing a key fall on the same side; class shares are preserved in
    expectation because the hash is independent of the label.
    """
    key_cols = list(key_cols or [spec.row_key])
    b = hash_bucket(key_cols, buckets, method=method)
    cut = int(round(ratio * buckets))
    return df.filter(b < cut), df.filter(b >= cut)


def split_label(df: DataFrame, key_cols: Sequence[str] | None = None, ratio: float = 0.8,
                buckets: int = 10, spec: Roles = WEATHER) -> DataFrame:
    """Adds ``split`` = 'train' / 'test' (the same assignment as :func:`hash_split`)."""
    key_cols = list(key_cols or [spec.row_key])
    cut = int(round(ratio * buckets))
    return df.withColumn("split", F.when(hash_bucket(key_cols, buckets) < cut, "train").otherwise("test"))


def exact_stratified(df: DataFrame, label: str | None = None, ratio: float = 0.8, key_cols: Sequence[str] | None = None,
                     spec: Roles = WEATHER) -> DataFrame:
    """Adds ``split``: exactly floor(ratio * n + 0.5) rows of each class are 'train', the rest 'test' (X1).

    The rows of the lowest md5 of the key are taken: a class's threshold is found
    by distributed selection on the digest's first 52 bits, and one more scan compares
    with it. Rows on the threshold itself (one digest, so copies of a key) are
    grouped by content and counted out. The same rows on any partitioning; a null
    label is a class; labels are few, as in a fitted model.
    """
    label, key_cols = label or spec.label, list(key_cols or [spec.row_key])
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    marked = materialize(df.withColumn("_at", F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long").cast("double")))
    cuts = [(key[0], own["_at"][0]) for key, own in
            select_quantiles(marked, ["_at"], [ratio], [label], stored=True, rank=lambda p, n: math.floor(p * n + 0.5)).items()]
    kind = marked.schema[label].dataType.simpleString()
    cut = df.sparkSession.createDataFrame(cuts, f"_label {kind}, _cut double")
    rows = marked.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
    train = F.when(F.col("_at") < F.col("_cut"), "train").otherwise("test")
    clear = rows.filter("_cut is null or _at <> _cut").select(*df.columns, train.alias("split"))
    below = marked.join(F.broadcast(cut), F.col(label).eqNullSafe(F.col("_label"))).groupBy("_label").agg(
        (F.floor(F.lit(ratio) * F.count(F.lit(1)) + 0.5) - F.count_if(F.col("_at") < F.col("_cut"))).alias("_take"))
    order = Window.partitionBy(label).orderBy(*[c for c in df.columns if c != label]).rowsBetween(Window.unboundedPreceding, -1)
    ties = rows.filter("_at = _cut").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    ties = ties.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    ties = ties.join(F.broadcast(below), F.col(label).eqNullSafe(F.col("_label")))
    taken = F.least(F.col("_n"), F.greatest(F.col("_take") - F.col("_before"), F.lit(0)))
    parts = F.concat(F.array_repeat(F.lit("train"), taken.cast("int")), F.array_repeat(F.lit("test"), (F.col("_n") - taken).cast("int")))
    return clear.unionByName(ties.select(*df.columns, F.explode(parts).alias("split")))


def stratified_split(df: DataFrame, label: str | None = None, weights: Sequence[float] = (0.8, 0.2),
                     seed: int = 2025, spec: Roles = WEATHER) -> tuple[DataFrame, DataFrame]:
    """Per-class ``randomSplit`` then union (the reference's split).

    Result depends on input partitioning; prefer :func:`hash_split` where
    reruns must agree.
    """
    label = label or spec.label
    trains, tests = [], []
    for value in spec.label_domain:
        tr, te = df.filter(F.col(label) == value).randomSplit(list(weights), seed)
        trains.append(tr)
        tests.append(te)
    train, test = trains[0], tests[0]
    for tr, te in zip(trains[1:], tests[1:]):
        train, test = train.unionByName(tr), test.unionByName(te)
    return train, test


def assign_folds(df: DataFrame, k: int, key_cols: Sequence[str] | None = None, col: str = "fold",
                 spec: Roles = WEATHER) -> DataFrame:
    """Adds an integer fold in [0, k) from digest bits independent of the split."""
    key_cols = list(key_cols or [spec.row_key])
    return df.withColumn(col, hash_bucket(key_cols, k, part=1).cast("int"))
