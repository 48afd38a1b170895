"""Dictionaries made from any table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reasons a row can be quarantined for.
NULL_TEXT = "null text"
NULL_WEIGHT = "null weight"
NEGATIVE_WEIGHT = "negative weight"
NUL = "NUL in text"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def dictionary_from(
    df: DataFrame,
    text: Column | str,
    weight: Column | str | None = None,
    aggregate: str | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """``text, weight`` from a table.

    Without ``weight`` the weight is the number of rows with that text. With
    ``weight`` the rows are taken as they are, or one per text when
    ``aggregate`` is ``min``, ``max`` or ``sum``. Rows that cannot be entries
    (see ``split_pairs``) stop the job, or are left out with ``on_bad='skip'``.
    """
    if on_bad not in ("fail", "skip"):
        raise ValueError(f"on_bad must be 'skip' or 'fail', not {on_bad!r}")
    text = _column(text)
    if weight is None:
        counted = df.select(text.alias("text")).filter(_good(_pair_reason(None), on_bad))
        return counted.groupBy("text").agg(F.count("*").alias("weight"))
    pairs = df.select(text.alias("text"), _column(weight).cast("bigint").alias("weight"))
    pairs = pairs.filter(_good(_pair_reason(F.col("weight")), on_bad))
    if aggregate is None:
        return pairs
    if aggregate not in ("min", "max", "sum"):
        raise ValueError(f"aggregate must be min, max or sum, not {aggregate!r}")
    return pairs.groupBy("text").agg(getattr(F, aggregate)("weight").alias("weight"))


def _good(reason: Column, on_bad: str) -> Column:
    if on_bad == "skip":
        return reason.isNull()
    return F.when(reason.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not an entry: "), reason)))


def _pair_reason(weight: Column | None) -> Column:
    text = F.col("text")
    reason = F.when(text.isNull(), NULL_TEXT).when(F.contains(text, F.lit("\0")), NUL)
    if weight is not None:
        reason = reason.when(weight.isNull(), NULL_WEIGHT).when(weight < 0, NEGATIVE_WEIGHT)
    return reason


def split_pairs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split ``text, weight`` rows into a dictionary and a quarantine with ``reason``."""
    judged = df.select("text", "weight").withColumn("reason", _pair_reason(F.col("weight")))
    good = judged.filter(F.col("reason").isNull()).select("text", "weight")
    return good, judged.filter(F.col("reason").isNotNull())


def word_dictionary(df: DataFrame, text: Column | str, separator: str = " ") -> DataFrame:
    """Words of a text column with the number of times each occurs."""
    words = df.select(F.explode(F.split(_column(text), re.escape(separator))).alias("text"))
    return dictionary_from(words.filter(F.col("text") != ""), "text")
