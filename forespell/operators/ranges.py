"""Lookups for whole tables of position ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.operators.topk import check_ties, scan_candidates, scan_ties
from forespell.plans.blocks import BlockMaxima, Windows, heaviest_of_narrow, heaviest_of_ranges, heaviest_of_wide, ranked_items, windows_of
from forespell.plans.prefixes import DEFAULT_K, QueryProfile, distinct_prefixes, hand_back, profile_queries
from forespell.plans.topn import LIMIT_PUSHED


def heaviest_in_ranges(maxima: BlockMaxima, ranges: DataFrame, ties: str = "last") -> DataFrame:
    """``rid, rank, pos, text, weight``: the ``k`` heaviest entries with ``lb <= pos < rb`` of every range.

    ``ranges`` has ``rid, lb, rb, k``; a missing ``k`` is 10. A range of up to a chunk of
    positions is answered in the row it came in; wider ones that are equal are looked up
    once, for the largest ``k``. A range that is empty, reversed, null or beyond the last
    position has no rows. ``ties`` as in ``heaviest_in_range``.
    """
    check_ties(ties)
    asked = ranges.select("rid", F.col("lb").cast("bigint"), F.col("rb").cast("bigint"), F.coalesce("k", F.lit(DEFAULT_K)).alias("k"))
    asked = asked.filter("lb < rb and rb > 0 and k > 0").withColumn("lb", F.greatest("lb", F.lit(0).cast("bigint")))
    scan = ties == "scan"
    windows = windows_of(maxima, scan)
    near = F.col("rb") - F.col("lb") <= windows.chunk
    sure = F.least(scan_candidates(F.col("k").cast("bigint")), F.lit((1 << 31) - 1)) if scan else F.col("k")
    found = heaviest_of_narrow(windows, asked.filter(near), sure).select("rid", "k", "best")
    found = ranked_items(found.select("rid", _scanned(F.col("k")).alias("best")) if scan else found.drop("k"))
    wide = asked.filter(~near).withColumn("prefix", F.concat_ws(":", "lb", "rb"))
    parts = [wide.filter(F.col("k") <= LIMIT_PUSHED // 2), wide.filter(F.col("k") > LIMIT_PUSHED // 2)]
    for part, few in zip(parts, [True, False], strict=True):
        distinct = distinct_prefixes(part)
        profile = profile_queries(distinct)
        if profile.prefixes:
            found = found.union(_wide_ranges(maxima, windows if few else None, part, distinct, profile, scan))
    return found


def _scanned(k: Column) -> Column:
    """``best`` by (weight desc, pos) finished by the scan tie rule, as ``scan_ties`` does it for rows; places are positions."""
    kth = F.array_min(F.transform(F.slice("best", F.lit(1), k), lambda e: e["weight"]))
    weighty = F.filter("best", lambda e: e["weight"] >= kth)
    by_pos = F.sort_array(F.transform(weighty, lambda e: F.struct((-e["place"]).alias("place"), e["weight"].alias("weight"), e["text"].alias("text"))))
    kept = F.filter(by_pos, lambda e, i: (e["weight"] > kth) | (i < k))
    best = F.transform(kept, lambda e: F.struct(e["weight"].alias("weight"), e["place"].alias("place"), e["text"].alias("text")))
    return F.slice(F.sort_array(best, asc=False), F.lit(1), k)


def _wide_ranges(
    maxima: BlockMaxima, windows: Windows | None, asked: DataFrame, distinct: DataFrame, profile: QueryProfile, scan: bool
) -> DataFrame:
    """The answers of ranges wider than a chunk, each looked up once; without windows from the block maxima."""
    n = scan_candidates(profile.max_k) if scan else profile.max_k
    bounds = [F.split_part("prefix", F.lit(":"), F.lit(i)).cast("bigint") for i in (1, 2)]
    wanted = distinct.select(
        F.col("prefix").alias("range"), bounds[0].alias("lb"), bounds[1].alias("rb"), (F.lit(n) if scan else F.col("k")).alias("n")
    )
    if windows:
        found = ranked_items(heaviest_of_wide(maxima, windows, wanted, n, scan), scan)
    else:
        found = heaviest_of_ranges(maxima, wanted, n, scan).drop("n")
    found = found.withColumnRenamed("range", "prefix")
    if not scan:
        returned = hand_back(asked, found, distinct, profile).filter(F.col("rank") <= F.col("k"))
        return returned.select("rid", "rank", "pos", "text", "weight")
    sizes = asked.select("prefix", "k").distinct()
    finished = scan_ties(found.join(sizes, "prefix"), ["prefix", "k"], F.col("k")).withColumnRenamed("k", "_k")
    returned = hand_back(asked, finished, distinct, profile).filter(F.col("k") == F.col("_k"))
    return returned.select("rid", "rank", "pos", "text", "weight")


def range_argmaxes(maxima: BlockMaxima, ranges: DataFrame) -> DataFrame:
    """``rid, pos, text, weight``: the heaviest entry with ``first <= pos <= last`` of every range, the later on a tie."""
    asked = ranges.select("rid", F.col("first").alias("lb"), (F.col("last") + 1).alias("rb"), F.lit(1).alias("k"))
    return heaviest_in_ranges(maxima, asked).drop("rank")
