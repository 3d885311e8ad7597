"""Streaming use of the batch operators (no stream-specific operator exists in
the reference): each micro-batch is audited with the same single-pass
operators, and fitted feature/model pipelines score streams directly.
"""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import WEATHER, Roles
from ..operators import audit


def audit_batch(batch: DataFrame, batch_id: int, spec: Roles = WEATHER) -> DataFrame:
    """(batch_id, check, column_name, n, pct) for one micro-batch: missing values and ranges."""
    miss = audit.missing_profile(batch, spec=spec).select(
        F.lit("missing").alias("check"), "column_name", F.col("n_missing").alias("n"), "pct")
    rng = audit.range_violations(batch, spec=spec).select(
        F.lit("out_of_range").alias("check"), "column_name", F.col("n_out").alias("n"),
        F.lit(None).cast("double").alias("pct"))
    return miss.unionByName(rng).select(F.lit(batch_id).cast("long").alias("batch_id"), "*")


def audit_stream(stream: DataFrame, sink_path: str, checkpoint: str, spec: Roles = WEATHER,
                 trigger: dict | None = None) -> StreamingQuery:
    """One audit table per micro-batch in a folder of its own; a replayed batch replaces its table.

    Reading ``sink_path`` gives batch_id from the folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # two audits read it
        try:
            (audit_batch(batch, batch_id, spec).drop("batch_id").write.mode("overwrite")
             .parquet(f"{sink_path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def score_stream(stream: DataFrame, features: PipelineModel, model: Model) -> DataFrame:
    """A fitted feature pipeline and classifier applied to a stream (M7 on streams).

    The label indexer needs the label column; rows scored before their label
    is known should go through the pipeline's feature stages only.
    """
    return model.transform(features.transform(stream))
