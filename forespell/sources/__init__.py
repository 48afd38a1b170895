"""Readers that produce dictionaries (``text, weight``) and queries (``qid, q, k``)."""

from forespell.sources.queries import (
    normalise_queries,
    queries_from,
    read_queries,
    split_queries,
    stream_queries,
)
from forespell.sources.tables import dictionary_from, split_pairs, word_dictionary
from forespell.sources.weighted_text import (
    parse_entries,
    read_lines,
    read_weighted_strings,
    split_valid,
)

__all__ = [
    "dictionary_from",
    "normalise_queries",
    "parse_entries",
    "queries_from",
    "read_lines",
    "read_queries",
    "read_weighted_strings",
    "split_pairs",
    "split_queries",
    "split_valid",
    "stream_queries",
    "word_dictionary",
]
