"""The completion table: for every prefix up to a length, its heaviest entries.

Built once, it answers a lookup at a cost that does not depend on how many
entries share the prefix.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.plans.prefixes import explode_prefixes, heaviest_first, keyed_entries, spelled
from forespell.plans.topn import LIMIT_PUSHED, top_n, within_reach

# How many prefix lengths are exploded from one set of survivors.
LENGTHS_PER_CUT = 5


def _cut(rows: DataFrame, prefix: str, k: int) -> DataFrame:
    """Before an exchange that no limit is pushed under: without what cannot be among the best ``k``."""
    if k <= LIMIT_PUSHED:
        return rows
    following = F.substring("key", F.length(prefix) + 1, F.lit(1))
    return within_reach(rows, prefix, following, F.lit(k), small=False)


def exploded_rows(keyed: DataFrame, lengths: Sequence[int], k: int) -> DataFrame:
    """``prefix, rank`` and the columns of ``keyed``, by exploding every entry into its prefixes."""
    exploded = _cut(explode_prefixes(keyed, "key", tuple(lengths)), "prefix", k)
    return top_n(exploded, ["prefix"], heaviest_first(keyed), k)


def rolled_up_rows(keyed: DataFrame, lengths: Sequence[int], k: int) -> list[DataFrame]:
    """The same rows, with the dictionary cut before it is exploded; one part per cut.

    An entry among the best ``k`` of a prefix is also among the best ``k`` of
    every longer prefix of its own. So what is not among the best of its longest
    prefix is in no list at all, and the shorter lists are made from the
    survivors alone. The order is total, which makes this exact.

    With many lengths the shorter half starts from survivors that are cut again;
    both halves read the same exchange.
    """
    longest = F.left(F.col("key"), F.lit(max(lengths)))
    survivors = top_n(_cut(keyed.withColumn("longest", longest), "longest", k), ["longest"], heaviest_first(keyed), k)
    survivors = survivors.drop("longest", "rank")
    if len(lengths) <= LENGTHS_PER_CUT:
        return [exploded_rows(survivors, lengths, k)]
    half = len(lengths) // 2
    return [exploded_rows(survivors, lengths[half:], k), *rolled_up_rows(survivors, lengths[:half], k)]


def pack_completions(rows: DataFrame) -> DataFrame:
    """``prefix, completions``: the ranked rows of a prefix as one ordered array."""
    collected = F.array_sort(F.collect_list(F.struct("rank", "text", "weight")))
    entries = F.transform(collected, lambda e: F.struct(e["text"].alias("text"), e["weight"].alias("weight")))
    return rows.groupBy("prefix").agg(entries.alias("completions"))


def _ranked_parts(
    dictionary: DataFrame, max_len: int, k: int, case_sensitive: bool, method: str
) -> list[DataFrame]:
    """``prefix, rank, text, weight``; no prefix is in two parts."""
    if k < 1:
        raise ValueError("k must be at least 1")
    if max_len < 0:
        raise ValueError("max_len must not be negative")
    if method not in ("explode", "rollup"):
        raise ValueError(f"method must be 'explode' or 'rollup', not {method!r}")
    keyed, lengths = keyed_entries(dictionary, case_sensitive), range(max_len + 1)
    if method == "rollup":
        parts = rolled_up_rows(keyed, lengths, k)
    else:
        parts = [exploded_rows(keyed, lengths, k)]
    return [spelled(part).select("prefix", "rank", "text", "weight") for part in parts]


def completion_rows(
    dictionary: DataFrame,
    max_len: int,
    k: int,
    case_sensitive: bool = True,
    method: str = "rollup",
) -> DataFrame:
    """``prefix, rank, text, weight`` for all prefixes of 0 to ``max_len`` characters.

    ``method='explode'`` ranks every entry under each of its prefixes;
    ``'rollup'`` (the default) first drops what cannot be in any list, so that
    only survivors are sorted once per length. Both give the same rows.
    """
    return reduce(DataFrame.unionByName, _ranked_parts(dictionary, max_len, k, case_sensitive, method))


def build_completion_table(
    dictionary: DataFrame,
    max_len: int,
    k: int,
    case_sensitive: bool = True,
    method: str = "rollup",
) -> DataFrame:
    """``prefix, completions`` for all prefixes of 0 to ``max_len`` characters.

    Packing the lists needs no further exchange: the rows of a part are already
    partitioned by prefix.
    """
    parts = _ranked_parts(dictionary, max_len, k, case_sensitive, method)
    packed = reduce(DataFrame.unionByName, map(pack_completions, parts))
    return packed.withMetadata("prefix", {"max_len": max_len, "k": k})


def table_bounds(table: DataFrame) -> tuple[int, int] | None:
    """``max_len, k`` a completion table was built for; kept with its schema, also when stored."""
    kept = table.schema["prefix"].metadata
    return (kept["max_len"], kept["k"]) if "max_len" in kept else None


def save_completion_table(table: DataFrame, path: str) -> None:
    """Store the table: one folder per prefix length, sorted by prefix inside.

    What it was built for is stored in the schema of its files.
    """
    kept = table.schema["prefix"].metadata
    (
        table.withColumn("prefix_length", F.length("prefix"))
        .repartitionByRange("prefix_length", "prefix")
        .sortWithinPartitions("prefix_length", "prefix")
        .withMetadata("prefix", kept)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("prefix_length")
        .parquet(path)
    )


def load_completion_table(spark: SparkSession, path: str) -> DataFrame:
    """Open a stored table as it was stored; ``prefix_length`` stays as the partition column."""
    return spark.read.parquet(path)
