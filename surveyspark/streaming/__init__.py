"""Streaming entry points: scoring of arriving coded rows and of arriving answer records."""

from surveyspark.streaming.scoring import answer_sink, read_answers, score_answers_stream, score_stream, score_stream_to_table

__all__ = ["answer_sink", "read_answers", "score_answers_stream", "score_stream", "score_stream_to_table"]
