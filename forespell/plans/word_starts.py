"""Stored word starts: where in which entry a word begins, sorted, without the texts.

A posting is the lower-cased stretch of ``reach`` characters from a word boundary and the
number of its entry. Queries meet postings by equality, as prefixes meet entries; the texts
are joined back by number at the end, once for each match.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.operators.filters import any_case, word_starts
from forespell.operators.prepare import with_position
from forespell.plans.prefixes import BROADCAST_BYTES, BROADCAST_ROWS, distinct_prefixes, exploded_for, probably_asked, profile_queries

REACH = 24


class WordStarts(NamedTuple):
    """``entry, text, weight`` and ``key, entry``; keys are cut to ``reach`` characters."""

    entries: DataFrame
    postings: DataFrame
    reach: int


def save_word_starts(dictionary: DataFrame, path: str, reach: int = REACH) -> None:
    """Store the entries by number and the postings by stretch, both sorted."""
    if reach < 1:
        raise ValueError("reach must be at least 1")
    path = path.rstrip("/")
    entries = with_position(dictionary.select("text", "weight"), unique=False).withColumnRenamed("pos", "entry")
    entries.repartitionByRange("entry").sortWithinPartitions("entry").write.mode("overwrite").parquet(f"{path}/entries")
    spark = dictionary.sparkSession
    stored = spark.read.parquet(f"{path}/entries")
    # two words of one entry may start alike, in other cases too
    pieces = F.array_distinct(F.transform(word_starts("text", reach), any_case))
    postings = stored.select(F.explode(pieces).alias("key"), "entry")
    postings.repartitionByRange("key", "entry").sortWithinPartitions("key", "entry").write.mode("overwrite").parquet(f"{path}/postings")
    spark.range(1).select(F.lit(reach).alias("reach")).coalesce(1).write.mode("overwrite").parquet(f"{path}/reach")


def load_word_starts(spark: SparkSession, path: str) -> WordStarts:
    path = path.rstrip("/")
    reach = spark.read.parquet(f"{path}/reach").first()["reach"]
    return WordStarts(spark.read.parquet(f"{path}/entries"), spark.read.parquet(f"{path}/postings"), reach)


def stored_word_start_matches(stored: WordStarts, queries: DataFrame) -> DataFrame:
    """``qid, text, weight`` as ``word_start_matches`` gives them, from stored word starts.

    A query longer than the stored reach meets the postings by its beginning and is
    compared with the text when that has been joined.
    """
    asked = queries.select("qid", any_case(F.coalesce("q", F.lit(""))).alias("whole"))
    asked = asked.withColumn("prefix", F.left("whole", F.lit(stored.reach)))
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    exploded = exploded_for(stored.postings.select("key", "entry"), distinct, profile)
    if profile.broadcasts() == 0:
        exploded = probably_asked(exploded, distinct, profile)
    # one entry may hold several words that begin with a prefix
    found = exploded.select("prefix", "entry").distinct()
    small = profile.broadcasts() == 1 and profile.queries <= BROADCAST_ROWS and profile.query_bytes <= BROADCAST_BYTES
    if small:
        found = exploded.join(F.broadcast(distinct.select("prefix")), "prefix", "left_semi").select("prefix", "entry").distinct()
    met = found.join(F.broadcast(asked) if small else asked, "prefix").select("qid", "whole", "entry")
    joined = met.join(stored.entries, "entry")
    longest = asked.agg(F.max(F.length("whole"))).first()[0] or 0
    if longest > stored.reach:
        begins = F.exists(word_starts("text", longest), lambda piece: any_case(piece).startswith(F.col("whole")))
        joined = joined.filter((F.length("whole") <= stored.reach) | begins)
    return joined.select("qid", "text", "weight")
