"""Continuous scoring of arriving requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from basketry.plans.features import Preprocessor
from basketry.plans.scoring import score_orders


def score_stream(requests: DataFrame, key: str, pre: Preprocessor, model: PipelineModel,
                 scored_path: str, rejected_path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch into ``scored_path`` and bad requests into ``rejected_path``.

    A batch always overwrites its own folder, so a replay after a failure
    leaves the same files.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read for both outputs; a lost part is read again from the source
        try:
            scored, rejected = score_orders(batch, key, pre, model)
            scored.write.mode("overwrite").parquet(f"{scored_path}/batch={number}")
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        finally:
            batch.unpersist()
    return (requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
