"""Incremental (Structured Streaming) runs of the additive jobs."""

from callstats.streaming.incremental import STREAMABLE, read_cdr_stream, start_incremental

__all__ = ["STREAMABLE", "read_cdr_stream", "start_incremental"]
