"""Structured Streaming ingest."""

from orderlayers.streaming.ingest import ingest_stream, stream_orders

__all__ = ["ingest_stream", "stream_orders"]
