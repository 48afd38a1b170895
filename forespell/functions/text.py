"""Text and weight expressions. Everything here is a built-in Spark expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Case folding touches these 26 letters and nothing else, and a
# "word character" is exactly the class below, whatever the locale.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_CHARS = "A-Za-z0-9_"

_FOLD_TABLE = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def fold(text: Column | str) -> Column:
    """ASCII lower case. ``lower()`` would also change letters such as É."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def fold_literal(text: str) -> str:
    """The same folding for a prefix that is known on the driver."""
    return text.translate(_FOLD_TABLE)


def match_key(dictionary: DataFrame, case_sensitive: bool) -> Column:
    """The column a prefix is compared with."""
    if case_sensitive:
        return F.col("text")
    return F.col("folded") if "folded" in dictionary.columns else fold("text")


def byte_length(text: Column | str) -> Column:
    return F.octet_length(text)


def parse_weight(raw: Column, weight_type: str = "bigint", trailing: str = "reject") -> Column:
    """Unsigned whole number, or null.

    Leading blanks and one trailing carriage return are ignored. With
    ``trailing='ignore'`` anything after the leading digits is dropped
    (``12abc`` is 12); the default turns such a field into null. A minus sign
    is never accepted. ``weight_type='decimal(20,0)'`` holds the full unsigned
    64-bit range.
    """
    if trailing == "reject":
        digits = F.regexp_extract(raw, r"^[ \t]*\+?([0-9]+)\r?\z", 1)
    elif trailing == "ignore":
        digits = F.regexp_extract(raw, r"^[ \t]*\+?([0-9]+)", 1)
    else:
        raise ValueError(f"trailing must be 'reject' or 'ignore', not {trailing!r}")
    return digits.try_cast(weight_type)


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common prefix of two strings, in code points.

    Whether the first ``n`` characters agree is monotone in ``n``, so the length
    is found by halving steps: 31 comparisons however long the strings are.
    """
    limit = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << bit) for bit in range(30, -1, -1)])

    def extend(done: Column, step: Column) -> Column:
        # limit - done never overflows, done + step might
        fits = step <= limit - done
        agrees = F.left(a, done + step) == F.left(b, done + step)
        return F.when(fits, F.when(agrees, done + step).otherwise(done)).otherwise(done)

    return F.left(a, F.aggregate(steps, F.lit(0), extend))


def quote_regex(literal: str) -> str:
    """Quote ``literal`` for a Java regular expression."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"
