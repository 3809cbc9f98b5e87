"""Structured Streaming twin of the file-incremental bronze load."""

from vigilo.streaming.incremental import ingest_available, stream_fixed_layout

__all__ = ["ingest_available", "stream_fixed_layout"]
