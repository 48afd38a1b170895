"""What comes next after a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.functions import common_prefix, match_key
from forespell.operators.filters import prefix_filter
from forespell.plans.prefixes import (
    distinct_prefixes,
    hand_back,
    keyed_entries,
    profile_queries,
    reduce_by_prefix,
    with_prefix,
)


def next_char_facets(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> DataFrame:
    """``next, matches, max_weight`` for every character that may follow ``prefix``.

    The empty string stands for the entry that ends there.
    """
    following = F.substring(match_key(dictionary, case_sensitive), len(prefix) + 1, 1)
    return (
        prefix_filter(dictionary, prefix, case_sensitive)
        .groupBy(following.alias("next"))
        .agg(F.count("*").alias("matches"), F.max("weight").alias("max_weight"))
    )


def next_char_facets_batch(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``qid, next, matches, max_weight`` for a table of prefixes."""
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)

    def facets(exploded: DataFrame) -> DataFrame:
        following = F.substring("key", F.length("prefix") + 1, F.lit(1))
        return exploded.groupBy("prefix", following.alias("next")).agg(
            F.count("*").alias("matches"), F.max("weight").alias("max_weight")
        )

    answers = reduce_by_prefix(keyed_entries(dictionary, case_sensitive), distinct, profile, facets)
    return hand_back(asked, answers, distinct, profile).select("qid", "next", "matches", "max_weight")


def common_extension(dictionary: DataFrame, prefix: str, case_sensitive: bool = True) -> DataFrame:
    """``extension``: the longest string all matches of ``prefix`` start with.

    The smallest and the largest match decide it. Null without a match.
    """
    key = match_key(dictionary, case_sensitive)
    ends = prefix_filter(dictionary, prefix, case_sensitive).agg(
        F.min(key).alias("first"), F.max(key).alias("last")
    )
    return ends.select(common_prefix(F.col("first"), F.col("last")).alias("extension"))


def common_extensions(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``qid, extension`` for a table of prefixes; null without a match."""
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)

    def ends(exploded: DataFrame) -> DataFrame:
        return exploded.groupBy("prefix").agg(F.min("key").alias("first"), F.max("key").alias("last"))

    answers = reduce_by_prefix(keyed_entries(dictionary, case_sensitive), distinct, profile, ends)
    answers = answers.select("prefix", common_prefix(F.col("first"), F.col("last")).alias("extension"))
    return hand_back(asked, answers, distinct, profile, "left").select("qid", "extension")
