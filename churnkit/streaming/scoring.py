"""Stateless scoring of a stream of files.

The reference has no streaming code; its scoring job is a stateless
transform, so the same ``batch_score`` runs on a streaming DataFrame:
``readStream`` of Parquet files -> score -> Parquet sink, with the
checkpoint in the shared folder.  ``availableNow`` processes what is there
and stops, which is how a scheduled scoring job runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnkit.operators.ml import batch_score


def score_stream(spark: SparkSession, model: PipelineModel, source: str, schema: str,
                 prepare: Callable[[DataFrame], DataFrame], features: Sequence[str], threshold: float,
                 passthrough: Sequence[str], sink: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> None:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = prepare(reader.parquet(source))
    scored = batch_score(model, stream, features, threshold, passthrough)
    q = (scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
