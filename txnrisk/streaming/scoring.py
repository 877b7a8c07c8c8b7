"""A saved model inside a stream: scores of live events, with the version of the model beside each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnrisk.operators import ml


def scored_stream(rows: DataFrame, model_path: str, version: str, threshold: float = ml.THRESHOLD) -> DataFrame:
    """(event_id, fraud_score, predicted_fraud, model_version) of Silver rows on a stream or in a table."""
    scored = ml.score(ml.feature_frame(rows), ml.load_model(model_path), threshold)
    return scored.select("event_id", "fraud_score", "predicted_fraud", F.lit(version).alias("model_version"))


def run(scores: DataFrame, path: str) -> StreamingQuery:
    """Append the scores of everything available to a table; the checkpoint makes each row count once."""
    return (
        scores.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start()
    )


def compared(live: DataFrame, batch: DataFrame) -> DataFrame:
    """Per event: does the stream's score equal the batch score of the same model, bit for bit?"""
    theirs = batch.select("event_id", F.col("fraud_score").alias("batch_score"))
    same = F.col("fraud_score").eqNullSafe(F.col("batch_score"))
    return live.join(theirs, "event_id", "full").select("event_id", same.alias("same"), "model_version")


