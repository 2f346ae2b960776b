"""Incremental versions of the bronze -> silver transform and of bar
resampling, on Structured Streaming."""

from bourse.streaming.ingest import bars_stream, silver_stream

__all__ = ["bars_stream", "silver_stream"]
