"""Structured Streaming: incremental ingest of newly arrived files."""

from snapmart.streaming.ingest import NullKeyError, ingest_available

__all__ = ["NullKeyError", "ingest_available"]
