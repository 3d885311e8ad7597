"""Left joins of rows with their groups' statistics that no null or hot key gathers in one task, and top-key semi-joins."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import counted_batches, materialize

#: Rows of a key from which it is dealt to SALTS parts; bytes of a table that may be broadcast; keys that may be sent as a filter.
HOT_ROWS, SALTS, BROADCAST_BYTES, FILTER_KEYS = 1_000_000, 64, 32 << 20, 10_000


def measured_broadcast(table: DataFrame, width: int = 0) -> DataFrame:
    """``table`` marked for broadcast if its rows, at their text bytes and eight bytes for each other column, fit BROADCAST_BYTES."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in table.dtypes if t == "string"]
    size = reduce(lambda a, b: a + b, texts, F.lit(width + 8 * len(table.columns)))
    return F.broadcast(table) if (table.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else table


def left_join(rows: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str], hot_rows: int = HOT_ROWS, salts: int = SALTS) -> DataFrame:
    """All ``rows`` with what each of ``tables`` (one row per key) has for their keys; nulls where it has none.

    A null key matches nothing, so such rows pass by the join unshuffled. Keys of
    more than ``hot_rows`` rows are counted first (there are at most rows /
    hot_rows of them); their rows are dealt to ``salts`` parts, each with a copy
    of the key's statistics. All others join plainly: all tables meet the rows on one shuffle.
    ``rows`` is read three times: store it first if it is dear to compute.
    """
    keys = list(keys)
    null = reduce(or_, [F.col(k).isNull() for k in keys])
    some, absent = rows.filter(~null), rows.filter(null)
    for table in tables:
        absent = absent.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name not in keys])
    hot = some.groupBy(*keys).count().filter(F.col("count") > hot_rows).drop("count").collect()
    if not hot:
        for table in tables:
            some = some.join(table, keys, "left")
        return some.unionByName(absent)
    marked = rows.sparkSession.createDataFrame([tuple(r) for r in hot], rows.select(*keys).schema).withColumn("_hot", F.lit(True))
    marked = measured_broadcast(marked)
    part = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0)
    some = some.join(marked, keys, "left").withColumn("_part", part).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    for table in tables:
        dealt = table.join(marked, keys, "left").withColumn("_part", F.explode(copies)).drop("_hot")
        some = some.join(dealt, [*keys, "_part"], "left")
    return some.drop("_part").unionByName(absent)


def join_statistics(rows: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """:func:`left_join` of all ``rows`` with fitted ``tables``, which are stored once.

    Tables that measure small (BROADCAST_BYTES each) are broadcast, so that the rows are read once
    and neither shuffled nor sorted; null keys match nothing there either. The others meet the rows by ``left_join``.
    """
    wide = []
    with counted_batches(rows.sparkSession):
        stored = [materialize(table) for table in tables]
    for table in stored:
        sent = measured_broadcast(table)
        if sent is table:
            wide.append(table)
        else:
            rows = rows.join(sent, list(keys), "left")
    return left_join(rows, wide, keys) if wide else rows


def semi_join_top(rows: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``top`` (J6), exactly; null keys match nothing.

    Up to FILTER_KEYS keys become a membership filter, which is pushed down to
    the files ahead of the join; more of them go by the join alone, broadcast if
    they measure small.
    """
    keys = top.select(key).filter(F.col(key).isNotNull()).distinct()
    known = [r[0] for r in keys.limit(FILTER_KEYS + 1).collect()]
    if len(known) <= FILTER_KEYS:
        rows = rows.filter(F.col(key).isin(known))
    return rows.join(measured_broadcast(keys), key, "left_semi")
