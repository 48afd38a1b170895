"""Predicates and range lookups for one prefix known on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.functions import WORD_CHARS, fold_literal, match_key

def starts_with(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> Column:
    """The match condition; on a stored column it is pushed down to the Parquet scan."""
    wanted = prefix if case_sensitive else fold_literal(prefix)
    return match_key(dictionary, case_sensitive).startswith(F.lit(wanted))


def prefix_filter(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> DataFrame:
    """Entries that start with ``prefix``; the original spelling is returned."""
    return dictionary.filter(starts_with(dictionary, prefix, case_sensitive))


def match_count(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> DataFrame:
    """How many entries start with ``prefix``, in one row ``matches``."""
    return prefix_filter(dictionary, prefix, case_sensitive).agg(F.count("*").alias("matches"))


def prefix_range(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> DataFrame:
    """``lb, rb``: the half-open range of sorted positions that ``prefix`` covers.

    Counted in one aggregate, without sorting. Without a match both are the
    place where the prefix would be inserted.
    """
    wanted = prefix if case_sensitive else fold_literal(prefix)
    below = match_key(dictionary, case_sensitive) < F.lit(wanted)
    matching = starts_with(dictionary, prefix, case_sensitive)
    counted = dictionary.agg(F.count_if(below).alias("lb"), F.count_if(matching).alias("matches"))
    return counted.select("lb", (F.col("lb") + F.col("matches")).alias("rb"))


def range_filter(positioned: DataFrame, lb: int, rb: int) -> DataFrame:
    """Entries with ``lb <= pos < rb``."""
    return positioned.filter((F.col("pos") >= lb) & (F.col("pos") < rb))


def any_case(text: Column | str) -> Column:
    """The form in which word starts are compared: lower case.

    The two characters outside ASCII whose lower case is ASCII (U+0130, U+212A)
    stay what they are, so no ASCII query finds them.
    """
    kept = F.translate(text, "\u0130\u212a", "\ue000\ue001")
    return F.lower(kept)


def word_starts(text: Column | str, reach: int) -> Column:
    """The distinct stretches of ``reach`` characters, or fewer at the end, that begin at a word boundary.

    The boundary is the ASCII one: between a character of ``[A-Za-z0-9_]`` and
    anything else.
    """
    begins, ends = f"(?<![{WORD_CHARS}])(?=[{WORD_CHARS}])", f"(?<=[{WORD_CHARS}])(?![{WORD_CHARS}])"
    piece = f"(?s)(?:{begins}|{ends})(?=(.{{1,{max(reach, 1)}}}))"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(piece), F.lit(1)))


def word_start_filter(dictionary: DataFrame, query: str) -> DataFrame:
    """Entries in which ``query`` begins at a word boundary, in any case.

    The rule of ``word_start_matches``: nothing in the query has a special meaning.
    """
    wanted = any_case(F.lit(query))
    starts = word_starts(F.col("text"), len(query))
    return dictionary.filter(F.exists(starts, lambda piece: any_case(piece).startswith(wanted)))
