"""Structured Streaming ingest (Bronze)."""

from tributary.streaming.bronze_stream import start_bronze_stream

__all__ = ["start_bronze_stream"]
