"""How the batch operators are laid out as Spark jobs: sizes, prefixes, roll-up, storage."""

from forespell.plans.blocks import block_maxima, load_block_maxima, save_block_maxima
from forespell.plans.completion_table import (
    build_completion_table,
    completion_rows,
    load_completion_table,
    pack_completions,
    save_completion_table,
)
from forespell.plans.positions import (
    load_positioned,
    save_positioned,
    stored_common_extension,
    stored_match_count,
    stored_prefix_range,
)
from forespell.plans.store import load_dictionary, load_or_build, save_dictionary
from forespell.plans.word_starts import load_word_starts, save_word_starts, stored_word_start_matches

__all__ = [
    "block_maxima",
    "build_completion_table",
    "completion_rows",
    "load_block_maxima",
    "load_completion_table",
    "load_dictionary",
    "load_or_build",
    "load_positioned",
    "load_word_starts",
    "pack_completions",
    "save_block_maxima",
    "save_completion_table",
    "save_dictionary",
    "save_positioned",
    "save_word_starts",
    "stored_common_extension",
    "stored_match_count",
    "stored_prefix_range",
    "stored_word_start_matches",
]
