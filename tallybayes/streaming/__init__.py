"""Streaming: a trained model applied to a stream, a sink that takes each row once, counts kept from a stream."""

from tallybayes.streaming.scoring import score_stream, write_predictions
from tallybayes.streaming.sink import OnceSink, count_stream, write_predictions_once

__all__ = ["OnceSink", "count_stream", "score_stream", "write_predictions", "write_predictions_once"]
