"""From "starts with" to equality: entries meet queries on exact prefixes.

A dictionary row is exploded into its prefixes of the lengths that occur among
the queries, and those are matched by equality. Every pair that is formed is a
real match, and no entry is compared with every query. Long prefixes are met in two
steps, first by a few anchors, so that a long text is not cut at every length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.functions import fold, match_key

# One broadcast holds at most this many distinct prefixes, and bytes of them. More
# are split over several broadcasts, each with its own pass over the dictionary;
# beyond that many passes the dictionary is shuffled instead.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
BROADCAST_PASSES = 8

# So few distinct prefixes become conditions of the scan, cut to this many characters.
FEW_PREFIXES = 100
STEM = 64

# Longer prefixes are met by anchors: the first LONG characters, four times as many, and so
# on. An entry has one row for each anchor, and further ones only below anchors it shares
# with a query.
LONG = 16
STRIDE = 4

# Rows of a bitmap of prefixes, 64 bits each; it is broadcast however many prefixes there are.
BITMAP_ROWS = 1 << 20

# A prefix repeated in more queries than this is spread over several tasks when
# the answers are handed back.
HOT_COPIES = 200_000

# What a query without ``k`` gets, as in a request without one.
DEFAULT_K = 10

# Prefixes are answered together, for the largest ``k`` among them. Those that want
# fewer get a pass of their own if the others would make an input partition ship more
# rows for them than this.
SPARE_ROWS = 1_000_000
FEW_ROWS = 32


class QueryProfile(NamedTuple):
    """Measured size of a query table; bounds what may be broadcast."""

    prefixes: int
    prefix_bytes: int
    query_bytes: int
    queries: int
    max_copies: int
    max_k: int
    first: str | None
    last: str | None
    lengths: tuple[int, ...]

    def broadcasts(self) -> int:
        """How many broadcasts the distinct prefixes take; 0 when they are too many."""
        if BROADCAST_ROWS < 1:
            return 0
        if self.prefixes <= BROADCAST_ROWS and self.prefix_bytes <= BROADCAST_BYTES:
            return 1
        # filled to half on average, so that an uneven split stays within the bound
        rows, size = self.prefixes / BROADCAST_ROWS, self.prefix_bytes / BROADCAST_BYTES
        needed = ceil(2 * max(rows, size))
        return needed if needed <= BROADCAST_PASSES else 0


def with_prefix(queries: DataFrame, case_sensitive: bool) -> DataFrame:
    """Add ``prefix``, the form of ``q`` that is compared with the match key.

    A missing ``q`` is the empty prefix, a missing ``k`` is ``DEFAULT_K``.
    """
    asked = F.coalesce(F.col("q"), F.lit(""))
    if "k" in queries.columns:
        queries = queries.withColumn("k", F.coalesce("k", F.lit(DEFAULT_K)))
    return queries.withColumn("prefix", asked if case_sensitive else fold(asked))


def distinct_prefixes(queries: DataFrame) -> DataFrame:
    """``prefix, k, copies``: each prefix once, with the largest ``k`` asked for."""
    k = F.max("k") if "k" in queries.columns else F.lit(1)
    return queries.groupBy("prefix").agg(k.alias("k"), F.count("*").alias("copies"))


def profile_queries(distinct: DataFrame) -> QueryProfile:
    """One aggregate over the queries. Only the distinct lengths reach the driver."""
    row = distinct.agg(
        F.count("*").alias("prefixes"),
        F.coalesce(F.sum(F.octet_length("prefix").cast("bigint")), F.lit(0)).alias("prefix_bytes"),
        F.coalesce(F.sum(F.col("copies") * (F.octet_length("prefix") + 16)), F.lit(0)).alias("query_bytes"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("queries"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("max_copies"),
        F.coalesce(F.max("k"), F.lit(1)).alias("max_k"),
        F.min("prefix").alias("first"),
        F.max(F.left("prefix", F.lit(1))).alias("last"),
        F.sort_array(F.collect_set(F.length("prefix"))).alias("lengths"),
    ).first()
    return QueryProfile(**{**row.asDict(), "lengths": tuple(row["lengths"])})


def by_size_of_k(distinct: DataFrame, profile: QueryProfile, pushed: int) -> list[tuple[DataFrame, QueryProfile]]:
    """Parts of the prefixes that are answered together: few rows each, up to ``pushed``, more than that.

    Without a reason to part them all stay together, and nothing is measured again.
    """
    parts, left, known = [], distinct, profile
    for limit in (FEW_ROWS, pushed):
        if known.prefixes * (known.max_k - limit) < SPARE_ROWS:
            continue
        smaller = left.filter(F.col("k") <= limit)
        measured = profile_queries(smaller)
        if measured.prefixes * (known.max_k - limit) < SPARE_ROWS:
            continue
        parts.append((smaller, measured))
        left = left.filter(F.col("k") > limit)
        known = profile_queries(left)
    return [*parts, (left, known)]


def explode_prefixes(keyed: DataFrame, key: str, lengths: tuple[int, ...]) -> DataFrame:
    """Add ``prefix``: one row per wanted length that the key is long enough for."""
    if not lengths:
        return keyed.withColumn("prefix", F.lit("")).filter(F.lit(False))
    first, last = lengths[0], lengths[-1]
    span = last - first + 1
    long_enough = keyed.filter(F.length(key) >= first)
    if len(lengths) * 2 >= span or len(lengths) > 64:
        # many lengths are wanted: generate all of them, up to the key's own length
        reach = F.least(F.length(key), F.lit(last))
        cut = long_enough.withColumn("_n", F.explode(F.sequence(F.lit(first), reach)))
        if len(lengths) < span:
            cut = cut.filter(F.col("_n").isin(*lengths))
    else:
        wanted = F.array(*[F.lit(n) for n in lengths])
        cut = long_enough.withColumn("_n", F.explode(wanted)).filter(F.col("_n") <= F.length(key))
    return cut.withColumn("prefix", F.left(F.col(key), F.col("_n"))).drop("_n")


def anchor_lengths(lengths: tuple[int, ...]) -> list[int]:
    """The anchors that prefixes of these lengths use: for each the longest that is no longer than it."""
    used = set()
    for n in lengths:
        anchor = LONG
        while n > LONG and anchor * STRIDE <= n:
            anchor *= STRIDE
        if n > LONG:
            used.add(anchor)
    return sorted(used)


def explode_long_prefixes(
    keyed: DataFrame, key: str, distinct: DataFrame, lengths: tuple[int, ...], small: bool
) -> DataFrame:
    """Add ``prefix`` for the prefixes above ``LONG`` characters.

    An entry first meets the anchors of the prefixes, by equality. Only where it shares an
    anchor it is cut to the lengths of the prefixes behind that anchor. So its rows are one
    for each anchor length, and not one for each length that anybody asks for. ``small`` says
    that the prefixes, and so their anchors, can be broadcast.
    """
    steps = F.array(*[F.lit(n) for n in anchor_lengths(lengths)])
    size = F.length("prefix")
    own = F.array_max(F.filter(steps, lambda n: n <= size))
    anchors = distinct.filter(size > LONG).select(F.left("prefix", own).alias("_anchor"), size.alias("_n"))
    anchors = anchors.groupBy("_anchor").agg(F.collect_set("_n").alias("_lengths"))
    reached = F.filter(steps, lambda n: n <= F.length(key))
    cut = keyed.filter(F.length(key) > LONG).withColumn("_n", F.explode(reached))
    cut = cut.withColumn("_anchor", F.left(F.col(key), F.col("_n"))).drop("_n")
    met = cut.join(F.broadcast(anchors) if small else anchors.hint("shuffle_merge"), "_anchor")
    met = met.withColumn("_n", F.explode(F.filter("_lengths", lambda n: n <= F.length(key)))).drop("_lengths", "_anchor")
    return met.withColumn("prefix", F.left(F.col(key), F.col("_n"))).drop("_n")


def exploded_for(keyed: DataFrame, distinct: DataFrame, profile: QueryProfile) -> DataFrame:
    """``keyed`` with ``prefix``, for short and long prefixes of ``distinct``."""
    short = tuple(n for n in profile.lengths if n <= LONG)
    if len(short) == len(profile.lengths):
        return explode_prefixes(keyed, "key", short)
    long = explode_long_prefixes(keyed, "key", distinct, profile.lengths, profile.broadcasts() > 0)
    return explode_prefixes(keyed, "key", short).unionByName(long) if short else long


def probably_asked(exploded: DataFrame, distinct: DataFrame, profile: QueryProfile) -> DataFrame:
    """``exploded`` without most of the prefixes that nobody asks for.

    A Bloom filter of one hash: the prefixes set bits of a bitmap, whose size is bounded, and
    rows whose bit is not set need not be shuffled. Eight bits for each prefix let one in
    eight others through; above eight million prefixes the share rises.
    """
    rows = 1
    while rows < BITMAP_ROWS and rows * 8 < profile.prefixes:
        rows *= 2
    place = F.xxhash64("prefix")
    word, bit = F.pmod(place, F.lit(rows)), F.shiftrightunsigned(place, 40).bitwiseAND(F.lit(63)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    bitmap = distinct.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    held = exploded.withColumn("_word", word).join(F.broadcast(bitmap), "_word")
    return held.filter(F.col("_bits").bitwiseAND(mask) != 0).drop("_word", "_bits")


def keyed_entries(dictionary: DataFrame, case_sensitive: bool, *extra: str) -> DataFrame:
    """``key, weight`` and any extra columns, plus ``text`` where it differs from the key.

    These rows are exploded and sorted, so the text is not carried twice.
    """
    key: Column = match_key(dictionary, case_sensitive)
    spelling = () if case_sensitive else ("text",)
    return dictionary.select(key.alias("key"), "weight", *spelling, *extra)


def spelled(rows: DataFrame) -> DataFrame:
    """Give the rows their ``text`` back."""
    return rows if "text" in rows.columns else rows.withColumn("text", F.col("key"))


def heaviest_first(keyed: DataFrame) -> list[Column]:
    """The total order of completions: heavier first, then the larger key, then the larger text."""
    spelling = [F.desc("text")] if "text" in keyed.columns else []
    return [F.desc("weight"), F.desc("key"), *spelling]


def narrowed(keyed: DataFrame, distinct: DataFrame, profile: QueryProfile) -> DataFrame:
    """``keyed`` without entries that no prefix can match; both conditions reach a stored scan.

    Always the range from the smallest prefix to the end of the last first
    character, which the profile knows; for few prefixes their stems as well.
    The empty prefix matches everything.
    """
    if not profile.first:
        return keyed
    key = F.col("key")
    up_to_last = (key < F.lit(profile.last)) | key.startswith(F.lit(profile.last))
    keyed = keyed.filter((key >= F.lit(profile.first)) & up_to_last)
    if profile.prefixes <= FEW_PREFIXES:
        stems = [r[0] for r in distinct.select(F.left("prefix", F.lit(STEM))).distinct().collect()]
        keyed = keyed.filter(reduce(Column.__or__, [key.startswith(F.lit(s)) for s in sorted(stems)]))
    return keyed


def reduce_by_prefix(
    keyed: DataFrame,
    distinct: DataFrame,
    profile: QueryProfile,
    reduce_rows: Callable[[DataFrame], DataFrame],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Apply ``reduce_rows`` to the matches of every wanted prefix.

    The columns ``carry`` of ``distinct`` come with the result; ``reduce_rows``
    must keep the columns it does not know.

    As long as the prefixes can be broadcast, the dictionary is filtered where it
    is read, and only what ``reduce_rows`` keeps per partition is shuffled. Beyond
    that the exploded dictionary is sifted by a bitmap of the prefixes and reduced, with
    map-side cuts, and the reduced rows meet the prefixes on the exchange that the
    reduction made.
    """
    narrow = narrowed(keyed, distinct, profile)
    wanted, how = distinct.select("prefix", *carry), "inner" if carry else "left_semi"
    broadcasts = profile.broadcasts()
    if broadcasts == 0:
        exploded = probably_asked(exploded_for(narrow, wanted, profile), wanted, profile)
        return reduce_rows(exploded).join(wanted.hint("shuffle_merge"), "prefix", how)
    slots = [wanted]
    if broadcasts > 1:
        slot = F.pmod(F.xxhash64("prefix"), F.lit(broadcasts))
        slots = [wanted.filter(slot == i) for i in range(broadcasts)]
    parts = [reduce_rows(exploded_for(narrow, some, profile).join(F.broadcast(some), "prefix", how)) for some in slots]
    return reduce(DataFrame.unionByName, parts)


def hand_back(
    queries: DataFrame,
    answers: DataFrame,
    distinct: DataFrame,
    profile: QueryProfile,
    how: str = "inner",
    hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """Join the answers per prefix to all queries that asked for it.

    A prefix that very many queries share is split: its queries get one of as
    many salts as it takes to stay below ``hot_copies`` each, and its few answers
    are repeated once per salt. At most BROADCAST_ROWS prefixes can be that
    common, so their list is safe to broadcast.
    """
    if profile.max_copies <= hot_copies:
        return queries.join(answers, "prefix", how)
    threshold = max(hot_copies, profile.queries // 1_000_000)
    salts = F.ceil(F.col("copies") / hot_copies).cast("int")
    hot = distinct.filter(F.col("copies") > threshold).select("prefix", salts.alias("_hot"))
    # rand, not a hash of the row: equal queries must part, too
    spread = F.floor(F.rand(17) * F.col("_hot")).cast("int")
    repeats = F.sequence(F.lit(0), F.col("_hot") - 1)
    left = (
        queries.join(F.broadcast(hot), "prefix", "left")
        .withColumn("_salt", F.coalesce(spread, F.lit(0)))
        .drop("_hot")
    )
    right = (
        answers.join(F.broadcast(hot), "prefix", "left")
        .withColumn("_salt", F.explode(F.coalesce(repeats, F.array(F.lit(0)))))
        .drop("_hot")
    )
    return left.join(right, ["prefix", "_salt"], how).drop("_salt")
