"""Completion and counting for whole tables of prefixes, and the shapes of the answer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forespell.operators.filters import any_case, word_starts
from forespell.operators.prepare import number_rows, partition_offsets
from forespell.operators.topk import check_ties, scan_candidates, scan_order, scan_ties
from forespell.plans.prefixes import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    LONG,
    QueryProfile,
    by_size_of_k,
    distinct_prefixes,
    exploded_for,
    hand_back,
    heaviest_first,
    keyed_entries,
    probably_asked,
    profile_queries,
    reduce_by_prefix,
    spelled,
    with_prefix,
)
from forespell.plans.topn import LIMIT_PUSHED, top_n, within_reach


def complete_batch(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
    ties: str = "last",
    keep_unmatched: bool = False,
    heavy_from: int | None = None,
) -> DataFrame:
    """``qid, rank, text, weight``: the ``k`` best completions of every query.

    ``queries`` has ``qid, q, k`` with ``k`` at least 1 (``normalise_queries``); a
    missing ``k`` is 10.
    Each distinct prefix is answered once, for the largest ``k`` anyone asks,
    and the answer is handed back to all its queries. With ``keep_unmatched`` a
    query without completions stays as one row of nulls.

    ``heavy_from`` (see ``heavy_weight``) makes large batches cheaper without
    changing the answer: common prefixes are settled by the heavy entries alone.
    """
    check_ties(ties)
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    how = "left" if keep_unmatched else "inner"
    if ties == "scan":
        return _complete_scan(dictionary, asked, distinct, profile, case_sensitive, how)
    answers = best_per_prefix(dictionary, distinct, profile, case_sensitive, heavy_from)
    returned = hand_back(asked, answers, distinct, profile, how)
    # a query may ask for fewer than its prefix was answered for
    wanted = F.col("rank") <= F.col("k")
    kept = returned.filter(wanted | F.col("rank").isNull() if keep_unmatched else wanted)
    return kept.select("qid", "rank", "text", "weight")


def heavy_weight(dictionary: DataFrame, share: float = 0.01) -> int | None:
    """A weight that about ``share`` of the entries reach; null for no entries.

    One pass over the weights. It may be kept with the dictionary and reused:
    the answers are exact whatever its value is.
    """
    return dictionary.agg(F.percentile_approx("weight", 1.0 - share)).first()[0]


def best_per_prefix(
    dictionary: DataFrame,
    distinct: DataFrame,
    profile: QueryProfile,
    case_sensitive: bool = True,
    heavy_from: int | None = None,
) -> DataFrame:
    """``prefix, rank, text, weight`` for the prefixes in ``distinct``."""
    keyed = keyed_entries(dictionary, case_sensitive)
    order = heaviest_first(keyed)
    parts = by_size_of_k(distinct, profile, LIMIT_PUSHED)

    def best_of(wanted: DataFrame, sizes: QueryProfile, entries: DataFrame) -> DataFrame:
        # ranks above what anyone asked of a prefix end here, before they are handed back
        best = lambda e: top_n(first_rows(e, sizes, sizes.max_k), ["prefix"], order, sizes.max_k)
        rows = reduce_by_prefix(entries, wanted, sizes, best, ["k"])
        return spelled(rows).filter(F.col("rank") <= F.col("k")).select("prefix", "rank", "text", "weight", "k")

    def ranked(entries: DataFrame, but: DataFrame | None = None) -> DataFrame:
        found = []
        for wanted, sizes in parts:
            rest = wanted if but is None else wanted.join(but, "prefix", "left_anti")
            found.append(best_of(rest, sizes, entries))
        return reduce(DataFrame.unionByName, found)

    if heavy_from is None:
        return ranked(keyed).drop("k")
    # A prefix with as many heavy matches as it needs is settled, for everything else is lighter.
    # What is common enough to be costly is settled here, on a small share of the
    # dictionary; the full pass is left with prefixes that match little.
    heavy = ranked(keyed.filter(F.col("weight") >= heavy_from))
    settled = heavy.filter(F.col("rank") == F.col("k")).select("prefix")
    remaining = ranked(keyed, settled)
    return heavy.join(settled, "prefix", "left_semi").unionByName(remaining).drop("k")


def first_rows(matches: DataFrame, sizes: QueryProfile, n: int, scan: bool = False) -> DataFrame:
    """``matches`` cut by counts where no limit is pushed: what cannot be among the first ``n`` of its prefix goes.

    Each prefix is held to what was asked of it, if that is known before the exchange.
    Among equal weights the order goes by key, hence by the character after the prefix:
    falling, or rising for the scan tie rule, whose positions rise with the key.
    """
    if n <= LIMIT_PUSHED:
        return matches
    asked = F.col("k") if "k" in matches.columns else F.lit(sizes.max_k)
    wanted = scan_candidates(asked.cast("bigint")) if scan else asked
    following = F.substring("key", F.length("prefix") + 1, F.lit(1))
    return within_reach(matches, "prefix", following, wanted, tie_desc=not scan, small=sizes.broadcasts() > 0)


def _complete_scan(
    dictionary: DataFrame,
    asked: DataFrame,
    distinct: DataFrame,
    profile: QueryProfile,
    case_sensitive: bool,
    how: str,
) -> DataFrame:
    """The scan tie rule depends on ``k`` itself, so it is finished per (prefix, k)."""
    keyed = keyed_entries(dictionary, case_sensitive, "pos")


    def candidates_of(part: DataFrame, sizes: QueryProfile) -> DataFrame:
        n = scan_candidates(sizes.max_k)
        first = lambda e: top_n(first_rows(e, sizes, n, scan=True), ["prefix"], scan_order(), n)
        return reduce_by_prefix(keyed, part, sizes, first, ["k"]).drop("k")

    parts = by_size_of_k(distinct, profile, (LIMIT_PUSHED + 1) // 2)
    candidates = reduce(DataFrame.unionByName, [candidates_of(*part) for part in parts])
    wanted = asked.select("prefix", "k").distinct()
    finished = scan_ties(candidates.join(wanted, "prefix"), ["prefix", "k"], F.col("k"))
    finished = spelled(finished).select("prefix", F.col("k").alias("_k"), "rank", "text", "weight")
    returned = hand_back(asked, finished, distinct, profile).filter(F.col("k") == F.col("_k"))
    returned = returned.select("qid", "rank", "text", "weight")
    if how == "inner":
        return returned
    unmatched = asked.join(candidates.select("prefix").distinct(), "prefix", "left_anti")
    return returned.unionByName(unmatched.select("qid"), allowMissingColumns=True)


def match_entries(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``qid, text, weight``: every entry that starts with the prefix of a query.

    The queries are broadcast as far as their measured size allows. Beyond that
    both sides are shuffled on the prefix; a prefix with very many entries or
    queries is a skewed partition of a plain inner sort-merge join, which
    adaptive execution splits on either side.
    """
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    exploded = exploded_for(keyed_entries(dictionary, case_sensitive), distinct, profile)
    if profile.broadcasts() == 0:
        exploded = probably_asked(exploded, distinct, profile)
    wanted = asked.select("qid", "prefix")
    small = profile.broadcasts() == 1 and profile.queries <= BROADCAST_ROWS and profile.query_bytes <= BROADCAST_BYTES
    wanted = F.broadcast(wanted) if small else wanted.hint("shuffle_merge")
    return spelled(exploded.join(wanted, "prefix")).select("qid", "text", "weight")


def _count_matches(exploded: DataFrame) -> DataFrame:
    return exploded.groupBy("prefix").agg(F.count("*").alias("matches"))


def match_counts(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``qid, matches``: how many entries start with each query; 0 is reported too."""
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    counts = reduce_by_prefix(keyed_entries(dictionary, case_sensitive), distinct, profile, _count_matches)
    returned = hand_back(asked, counts, distinct, profile, "left")
    return returned.select("qid", F.coalesce("matches", F.lit(0)).alias("matches"))


def prefix_ranges(
    dictionary: DataFrame,
    queries: DataFrame,
    case_sensitive: bool = True,
) -> DataFrame:
    """``qid, lb, rb``: the half-open range of sorted positions each query covers.

    As long as the queries and their own prefixes can be broadcast, the ranges
    come from counts: the entries in front of a prefix are those that leave its
    path at some character for a smaller one. Beyond that, and for long prefixes,
    entries and prefixes are sorted together.
    """
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    keyed = keyed_entries(dictionary, case_sensitive)
    nodes_profile = None
    # the paths of long prefixes hold the square of their lengths: not even measured
    if max(profile.lengths, default=0) <= LONG:
        steps = _path_steps(distinct)
        nodes = distinct_prefixes(steps.select(F.col("node").alias("prefix")))
        nodes_profile = profile_queries(nodes)
    if nodes_profile and nodes_profile.broadcasts() == 1:
        ranges = _ranges_by_counting(keyed, steps, nodes, nodes_profile)
    else:
        ranges = _ranges_by_sorting(keyed, distinct, profile)
    return hand_back(asked, ranges, distinct, profile).select("qid", "lb", "rb")


def _path_steps(distinct: DataFrame) -> DataFrame:
    """``prefix, node, next``: each prefix with its own prefixes and the character after.

    The last step of a prefix is the prefix itself, followed by the empty string.
    """
    depth = F.explode(F.sequence(F.lit(0), F.length("prefix")))
    return distinct.select("prefix", depth.alias("_n")).select(
        "prefix",
        F.left(F.col("prefix"), F.col("_n")).alias("node"),
        F.substring("prefix", F.col("_n") + 1, F.lit(1)).alias("next"),
    )


def _ranges_by_counting(
    keyed: DataFrame, steps: DataFrame, nodes: DataFrame, nodes_profile: QueryProfile
) -> DataFrame:
    """``prefix, lb, rb`` from one scan of the dictionary with map-side sums."""

    def branches(exploded: DataFrame) -> DataFrame:
        following = F.substring("key", F.length("prefix") + 1, F.lit(1))
        return exploded.groupBy("prefix", following.alias("next")).agg(F.count("*").alias("matches"))

    counted = reduce_by_prefix(keyed, nodes, nodes_profile, branches)
    # a query may take a branch that no entry takes
    taken = steps.select(F.col("node").alias("prefix"), "next", F.lit(0).cast("bigint").alias("matches"))
    branch = counted.unionByName(taken).groupBy("prefix", "next").agg(F.sum("matches").alias("matches"))
    siblings = Window.partitionBy("prefix")
    smaller = siblings.orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
    placed = branch.select(
        F.col("prefix").alias("node"),
        "next",
        F.coalesce(F.sum("matches").over(smaller), F.lit(0)).alias("smaller"),
        F.sum("matches").over(siblings).alias("inside"),
    )
    arrived = F.when(F.col("node") == F.col("prefix"), F.col("inside"))
    return (
        steps.join(placed, ["node", "next"])
        .groupBy("prefix")
        .agg(F.sum("smaller").alias("lb"), F.max(arrived).alias("inside"))
        .select("prefix", "lb", (F.col("lb") + F.col("inside")).alias("rb"))
    )


def _ranges_by_sorting(keyed: DataFrame, distinct: DataFrame, profile: QueryProfile) -> DataFrame:
    """``prefix, lb, rb`` from sorting entries and prefixes together.

    A prefix comes before the entries it is not larger than, so the entries in
    front of it are its ``lb``.
    """
    entries = keyed.select("key", F.lit(1).alias("entry"))
    marks = distinct.select(F.col("prefix").alias("key"), F.lit(0).alias("entry"))
    numbered = number_rows(entries.union(marks), [F.col("key"), F.col("entry")])
    offsets = partition_offsets(numbered, F.col("entry"))
    earlier_marks = F.row_number().over(Window.partitionBy("part").orderBy("row")) - 1
    bounds = (
        numbered.filter(F.col("entry") == 0)
        .withColumn("_marks", earlier_marks)
        .join(F.broadcast(offsets), "part")
        .select(F.col("key").alias("prefix"), (F.col("before") + F.col("row") - F.col("_marks")).alias("lb"))
    )
    counts = reduce_by_prefix(keyed, distinct, profile, _count_matches)
    return bounds.join(counts, "prefix", "left").select(
        "prefix", "lb", (F.col("lb") + F.coalesce("matches", F.lit(0))).alias("rb")
    )


def word_start_matches(dictionary: DataFrame, queries: DataFrame) -> DataFrame:
    """``qid, text, weight``: entries in which the query begins at a word boundary.

    The batch form of ``word_start_filter``, by the same rule. Every entry is cut at its word boundaries and the pieces meet the
    queries by equality. A piece is as long as the longest query, which is all
    that can matter.
    """
    asked = queries.withColumn("prefix", any_case(F.coalesce("q", F.lit(""))))
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    reach = max(profile.lengths, default=0)
    keyed = dictionary.select("text", "weight", F.explode(word_starts("text", reach)).alias("piece"))
    keyed = keyed.select("text", "weight", any_case("piece").alias("key"))

    def once(exploded: DataFrame) -> DataFrame:
        # two words of one entry may start alike
        return exploded.select("prefix", "text", "weight").distinct()

    matches = reduce_by_prefix(keyed, distinct, profile, once)
    return hand_back(asked, matches, distinct, profile).select("qid", "text", "weight")


def to_lines(completions: DataFrame) -> DataFrame:
    """``line``: text, two blanks, weight; ``qid`` and ``rank`` stay for ordering."""
    line = F.concat_ws("  ", "text", F.col("weight").cast("string"))
    return completions.select("qid", "rank", line.alias("line"))


def suggestions_rows(completions: DataFrame) -> DataFrame:
    """``qid, value, data``: the text and its 0-based rank as a string."""
    return completions.select("qid", F.col("text").alias("value"), (F.col("rank") - 1).cast("string").alias("data"))


def suggestions_json(completions: DataFrame) -> DataFrame:
    """One suggestion document ``json`` per query, heaviest first.

    From ``qid, rank, text, weight`` it returns ``qid, json``. Give it
    completions made with ``keep_unmatched=True`` and a query without any gets an
    empty list. A query has at most ``k`` rows, so its group is small. Rows that
    hold an array ``completions`` (streams, the completion table) need no
    grouping: the array is replaced by ``json``, null where it is null.
    """
    if "completions" in completions.columns:
        document = _suggestion_document(F.col("completions"))
        known = F.when(F.col("completions").isNotNull(), document)
        return completions.withColumn("json", known).drop("completions")
    found = F.when(F.col("rank").isNotNull(), F.struct("rank", "text"))
    ordered = F.array_sort(F.collect_list(found))
    return completions.groupBy("qid").agg(_suggestion_document(ordered).alias("json"))


def _suggestion_document(entries: Column) -> Column:
    """Ordered entries with ``text`` as JSON; the 0-based place is a string."""
    suggestions = F.transform(
        entries, lambda e, place: F.struct(e["text"].alias("value"), place.cast("string").alias("data"))
    )
    return F.to_json(F.struct(suggestions.alias("suggestions")))
