"""Incremental (Structured Streaming) execution of the landing -> gold transform."""

from .landing import landing_stream, make_batch_writer, start_incremental_pipeline

__all__ = ["landing_stream", "make_batch_writer", "start_incremental_pipeline"]
