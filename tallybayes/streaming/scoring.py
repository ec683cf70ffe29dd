"""Apply a trained model to a streaming DataFrame.

The map scorer is made of stream-static joins (broadcast where the part of the
model is small enough, merge joins beyond) plus per-row expressions, so each
micro-batch is scored independently: no state store, no watermark, and a
restarted query resumes from its checkpointed source offsets. ``sink.py`` has the
way through micro-batches, which serves every scorer and keeps counts too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallybayes.operators.predict import predict
from tallybayes.operators.prepare import prepare
from tallybayes.operators.train import NBModel
from tallybayes.sources.spec import DatasetSpec


def score_stream(stream: DataFrame, spec: DatasetSpec, model: NBModel, **bounds) -> DataFrame:
    """Predictions for a streaming table with the columns named by ``spec``; ``bounds`` as in ``predict``."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame")
    # the long scorer regroups rows, a stateful aggregation that an append-mode
    # stream cannot run; the map scorer only joins, at any model size
    return predict(prepare(stream, spec), model, spec.ids, scorer="map", **bounds)


def write_predictions(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append predictions as Parquet; ``checkpoint`` must be on shared storage."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
