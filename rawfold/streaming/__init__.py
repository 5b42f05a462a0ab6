"""Structured Streaming driver for the staging recipe."""

from rawfold.streaming.available_now import stage_stream

__all__ = ["stage_stream"]
