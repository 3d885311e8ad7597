"""General readers and writers: CSV with header, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("csv", "parquet")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
               header: bool = True, **options) -> DataFrame:
    """A table at ``path``. CSV without a schema is inferred, which reads the files once more."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", header).option("inferSchema", schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", header: bool = True,
                partition_by: tuple[str, ...] = (), **options) -> str:
    """Write ``df`` to ``path``; many files, one per task. Returns the path."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    writer = df.write.mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return path
