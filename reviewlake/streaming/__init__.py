"""Structured Streaming: message source -> bronze -> silver, plus windowed trend."""

from reviewlake.streaming.pipeline import (  # noqa: F401
    stream_source, stream_to_bronze, silver_stream, hourly_trend_stream, dedup_stream,
)
