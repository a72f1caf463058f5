"""Structured Streaming jobs."""

from .incremental import incremental_stream, payload_stream

__all__ = ["incremental_stream", "payload_stream"]
