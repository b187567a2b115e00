"""Streaming use of the batch transforms.

The reviewed project has no streaming operators (no windows, watermarks or state). What
carries over is that every cleaning step is a stateless Column expression and every fitted
model a ``Transformer``, so the same code scores reviews as they arrive:
:func:`score_stream` applies them to a ``readStream`` source and writes each micro-batch
idempotently (keyed by batch id) with ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions import text as T


def clean_stream(stream: DataFrame, text_col: str = "text", opts: T.CleanOptions = T.CleanOptions()) -> DataFrame:
    return stream.withColumn("tokens", T.clean_text(F.col(text_col), opts))


def score_stream(stream: DataFrame, model, out_path: str, checkpoint: str, text_col: str = "text", trigger: dict | None = None):
    """Clean, score with a fitted PipelineModel and append each batch under
    ``out_path/batch_id=<id>`` (a replayed batch overwrites its own folder)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        model.transform(batch).drop("features", "rawPrediction").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = clean_stream(stream, text_col).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = q.trigger(**(trigger or {"availableNow": True}))
    return q.start()
