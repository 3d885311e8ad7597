"""A training corpus from raw documents: quality, lines, near-duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each result as Parquet in the
shared folder and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm import lines, mix, pack, quality, simhash
from pluvio.llm.common import stage
from pluvio.llm.queries import ranks_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality rules reject; all other rows stay as they are."""
    return quality.keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that ten documents or more have; a document that loses some has a new n_chars.

    A document of such lines alone stays with an empty text.
    """
    kept = lines.dedup_lines(docs.select(*COLUMNS))
    changed = F.col("n_dropped") > 0
    return kept.select("doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
                       F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked fingerprints: that of the smallest doc_id.

    Of rows that share the id, the first in the order of their digests stays.
    Rows without an id come last: one stays where its group has no other. Ids may
    repeat in several groups; each keeps its own row.
    """
    docs = docs.select(*COLUMNS)
    # 128 bits that name a row's content; rows that agree in all columns are interchangeable
    gaps = F.concat(*[F.isnull(c).cast("string") for c in COLUMNS])
    docs = docs.withColumns({f"_r{k}": F.xxhash64(F.lit(k), gaps, *COLUMNS) for k in (1, 2)})
    found = simhash.near_duplicates(docs, keep=["_r1", "_r2"])
    least = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "_r1", "_r2")).alias("w")
    first = found.groupBy("component").agg(least).select("w._r1", "w._r2")
    # copies of a row meet before the join, combined in the tasks that read them
    rows = docs.groupBy("_r1", "_r2").agg(*[F.first(c).alias(c) for c in COLUMNS])
    return rows.join(first, ["_r1", "_r2"], "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix begins it: none, once or twice.

    The mix cuts at most one document of a source, its last; that one is taken
    whole. Documents without words take no part.
    """
    docs = docs.select(*COLUMNS)
    key = F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("")), F.isnull("source"))
    keyed = docs.withColumn("_id", F.struct(F.col("doc_id").alias("id"), key.alias("key")))
    shares = mix.document_shares(mix.mix(keyed.select(F.col("_id").alias("doc_id"), "text", "source")))
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    # rows that repeat have one place each in their source; their copies are added up and shared out again
    taken = shares.filter("taken > 0").groupBy("doc_id").agg(F.sum(copies).alias("_copies"))
    numbered = keyed.join(taken.withColumnRenamed("doc_id", "_id"), "_id")
    order = Window.partitionBy("_id").orderBy("lang", "n_chars")
    once = numbered.withColumn("_n", F.row_number().over(order)).withColumn("_rows", F.count("*").over(Window.partitionBy("_id")))
    own = F.expr("_copies div _rows + if(_n <= _copies % _rows, 1, 0)").cast("int")
    return once.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), own))).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack.pack_documents(docs.select(*COLUMNS), *ranks_file())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources),
          ("best_fit_packing", best_fit_packing)]

#: Fingerprints, the mixture's schedule and the packing have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
