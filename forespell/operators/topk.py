"""Top-k completions for one prefix or one position range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forespell.functions import match_key
from forespell.operators.filters import prefix_filter, range_filter

TIES = ("last", "scan")


def check_k(k: int) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")


def check_ties(ties: str) -> None:
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, not {ties!r}")


def scan_candidates(k: int) -> int:
    """How many rows by (weight desc, pos) decide the scan tie rule for ``k``.

    They contain every row heavier than the k-th weight (fewer than ``k``) and
    the first ``k`` rows, by position, of exactly that weight. A tied row
    further back comes after ``k`` kept rows and cannot enter.
    """
    return 2 * k - 1


def scan_order() -> list[Column]:
    return [F.desc("weight"), F.asc("pos")]


def scan_ties(candidates: DataFrame, keys: list[str], k: Column) -> DataFrame:
    """Finish the scan tie rule on the candidates of each group, adding ``rank``.

    The rule is that of one pass over the positions with a heap of ``k``: a
    later entry enters only if it is strictly heavier than the lightest one
    kept. ``candidates`` carries ``rank`` by (weight desc, pos).
    """
    group = Window.partitionBy(*keys)
    kth = F.min(F.when(F.col("rank") <= k, F.col("weight"))).over(group)
    scanned = F.row_number().over(group.orderBy("pos"))
    final = F.row_number().over(group.orderBy(F.desc("weight"), F.desc("pos")))
    return (
        candidates.withColumn("_kth", kth)
        .filter(F.col("weight") >= F.col("_kth"))
        .withColumn("_scanned", scanned)
        .filter((F.col("weight") > F.col("_kth")) | (F.col("_scanned") <= k))
        .withColumn("rank", final)
        .filter(F.col("rank") <= k)
        .drop("_kth", "_scanned")
    )


def _best(rows: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows with their rank.

    ``orderBy`` plus ``limit`` keeps ``k`` rows per partition before anything
    moves; the ranking window sees only the ``k`` rows that are left.
    """
    return rows.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def heaviest_in_range(positioned: DataFrame, lb: int, rb: int, k: int, ties: str = "last") -> DataFrame:
    """``rank, pos, text, weight``: the ``k`` heaviest entries with ``lb <= pos < rb``.

    On equal weights the later position wins, or with ``ties='scan'`` whatever a
    single pass with a bounded heap would have kept.
    """
    check_k(k)
    check_ties(ties)
    inside = range_filter(positioned, lb, rb).select("pos", "text", "weight")
    if ties == "last":
        best = _best(inside, [F.desc("weight"), F.desc("pos")], k)
    else:
        ranked = _best(inside, scan_order(), scan_candidates(k)).withColumn("_all", F.lit(0))
        best = scan_ties(ranked, ["_all"], F.lit(k))
    return best.select("rank", "pos", "text", "weight")


def complete(
    dictionary: DataFrame,
    prefix: str,
    k: int = 5,
    case_sensitive: bool = True,
    ties: str = "last",
) -> DataFrame:
    """``rank, text, weight``: the ``k`` heaviest entries that start with ``prefix``.

    On equal weights the larger text comes first. ``ties='scan'`` needs a
    dictionary with ``pos`` (see ``with_position``).
    """
    check_k(k)
    check_ties(ties)
    matches = prefix_filter(dictionary, prefix, case_sensitive)
    if ties == "scan":
        ranked = _best(matches, scan_order(), scan_candidates(k)).withColumn("_all", F.lit(0))
        return scan_ties(ranked, ["_all"], F.lit(k)).select("rank", "text", "weight")
    keyed = matches.select("text", "weight", match_key(dictionary, case_sensitive).alias("key"))
    order = [F.desc("weight"), F.desc("key"), F.desc("text")]
    return _best(keyed, order, k).select("rank", "text", "weight")
