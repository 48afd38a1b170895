"""Completion for streams of prefixes."""

from forespell.streaming.completions import complete_from_table, complete_stream, complete_stream_batch

__all__ = ["complete_from_table", "complete_stream", "complete_stream_batch"]
