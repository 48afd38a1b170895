"""Column expressions used by the operators."""

from forespell.functions.text import (
    WORD_CHARS,
    byte_length,
    common_prefix,
    fold,
    fold_literal,
    match_key,
    parse_weight,
    quote_regex,
)

__all__ = [
    "WORD_CHARS",
    "byte_length",
    "common_prefix",
    "fold",
    "fold_literal",
    "match_key",
    "parse_weight",
    "quote_regex",
]
