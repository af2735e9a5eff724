"""Incremental run of the cleaning job over arriving raw files."""

from footfall.streaming.incremental_clean import raw_stream, start_clean_stream

__all__ = ["raw_stream", "start_clean_stream"]
