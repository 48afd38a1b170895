"""Operators on dictionaries (``text, weight``) and query tables (``qid, q, k``)."""

from forespell.operators.batch import (
    complete_batch,
    heavy_weight,
    match_counts,
    match_entries,
    prefix_ranges,
    suggestions_json,
    suggestions_rows,
    to_lines,
    word_start_matches,
)
from forespell.operators.edges import prefix_edges
from forespell.operators.filters import (
    match_count,
    prefix_filter,
    prefix_range,
    range_filter,
    word_start_filter,
)
from forespell.operators.navigate import (
    common_extension,
    common_extensions,
    next_char_facets,
    next_char_facets_batch,
)
from forespell.operators.prepare import (
    dedup,
    input_stats,
    range_argmax,
    row_counts,
    sort_dictionary,
    with_folded,
    with_position,
)
from forespell.operators.ranges import heaviest_in_ranges, range_argmaxes
from forespell.operators.topk import complete, heaviest_in_range

__all__ = [
    "common_extension",
    "common_extensions",
    "complete",
    "complete_batch",
    "dedup",
    "heaviest_in_range",
    "heaviest_in_ranges",
    "heavy_weight",
    "input_stats",
    "match_count",
    "match_counts",
    "match_entries",
    "next_char_facets",
    "next_char_facets_batch",
    "prefix_edges",
    "prefix_filter",
    "prefix_range",
    "prefix_ranges",
    "range_argmax",
    "range_argmaxes",
    "range_filter",
    "row_counts",
    "sort_dictionary",
    "suggestions_json",
    "suggestions_rows",
    "to_lines",
    "with_folded",
    "with_position",
    "word_start_filter",
    "word_start_matches",
]
