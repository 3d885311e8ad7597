"""Helpers shared by the operators: staging, spreading and distributed ranks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The ASCII white space every contract speaks of: space and \t to \r.
WHITE = " \t\n\x0b\f\r"
#: Bytes of a table that may be broadcast, and parts that a key's rows are dealt to beyond that.
BROADCAST_BYTES, SALTS = 32 << 20, 64


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a session that names none and runs in one process (tests) gets a
    folder of its own; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pluvio-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor replays from the files, and each reader
    prunes the columns it does not need.
    """
    path = f"{scratch_dir(df.sparkSession)}/pluvio-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Deal rows out evenly, or by a hash of ``keys``, before work that is heavy per row.

    A file written as few large row groups gives few scan tasks whatever its
    size; AQE merges the parts again where they are small. Without keys no value
    that repeats, or null, gathers rows in one part.
    """
    if keys:
        return df.repartition(*keys)
    return df.withColumn("_deal", F.monotonically_increasing_id()).repartition("_deal").drop("_deal")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join to each row what its group has; ``groups`` is staged, with a text ``key`` and numbers of eight bytes at most.

    Within BROADCAST_BYTES, which its rows are measured against, ``groups`` is
    broadcast; beyond that a group's rows are dealt to SALTS parts and each part
    joins a copy of the group's row. So no task gathers a hot group, whatever the
    table's size is taken for when the plan is made. The result is the same.
    """
    width = F.coalesce(F.octet_length(key), F.lit(0)) + 8 * len(groups.columns)
    if (groups.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(groups), key, how)
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def text_bytes(df: DataFrame, text: str = "text") -> Column:
    """The text's UTF-8 bytes, for Arrow batches without decoding."""
    return F.coalesce(df[text], F.lit("")).cast("binary")


def running(df: DataFrame, group: Sequence[str], by: Column, ties: Sequence[str], value: str, out: str,
            per_part: int = 50_000) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one in its group.

    Rows stand in the order of the 64-bit hash ``by`` (unsigned), then ``ties``.
    The hash's top bits cut every group into parts of about ``per_part`` rows of
    the whole table, so a group of any size is summed in many tasks; part totals
    give each part its start. ``df`` is read three times: stage it first. Group
    columns must not be null. Rows equal in hash and ties are interchangeable.
    """
    bits = max(0, (max(1, df.count()) - 1) // per_part).bit_length()
    part = F.shiftrightunsigned(F.col("_h"), 64 - bits) if bits else F.lit(0).cast("long")
    cut = df.withColumn("_h", by).withColumn("_part", part)
    keys = [*group, "_part"]
    within = Window.partitionBy(*keys).orderBy(F.col("_h").bitwiseXOR(F.lit(-(1 << 63))), *ties).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (cut.groupBy(*keys).agg(F.sum(value).alias("_total"))
              .select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")))
    return (cut.withColumn(out, F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(starts, keys).withColumn(out, F.col(out) + F.col("_start"))
            .drop("_h", "_part", "_start"))


def numbered(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Stage ``df`` sorted by ``order`` with ``out``, each row's place from 0.

    The sort deals ranges of rows to tasks; counts per task (one row for each)
    turn places within a task into places in the whole.
    """
    placed = stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
              .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    return (placed.withColumn("_task", task).join(F.broadcast(starts), "_task")
            .withColumn(out, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_task", "_at", "_start"))
