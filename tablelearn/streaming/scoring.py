"""Apply a fitted model to a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.bayes import NBModel, nb_predict
from ..operators.cluster import KMeansModel, kmeans_predict
from ..operators.linear import LinearModel, linear_predict
from ..operators.mixture import GMMModel, gmm_predict
from ..operators.tree import ID3Model, id3_predict


def score_stream(stream: DataFrame, model) -> DataFrame:
    """The model's predict: stateless expressions, or joins with static model tables (valid on streams)."""
    if isinstance(model, KMeansModel):
        return kmeans_predict(stream, model)
    if isinstance(model, LinearModel):
        return linear_predict(stream, model)
    if isinstance(model, GMMModel):
        return gmm_predict(stream, model)
    if isinstance(model, ID3Model):
        return id3_predict(stream, model)
    if isinstance(model, NBModel):
        return nb_predict(stream, model)
    raise TypeError(f"no stream scoring for {type(model).__name__}")


def start_scoring(stream: DataFrame, model, sink_path: str, checkpoint: str, trigger_once: bool = False):
    """Score a stream into parquet files (append mode, exactly-once via the checkpoint)."""
    writer = (score_stream(stream, model).writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
