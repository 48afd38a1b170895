"""Completion for streams of prefixes. No state is kept, so no watermark is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from forespell.functions import fold
from forespell.operators.batch import complete_batch, suggestions_json
from forespell.plans.completion_table import table_bounds
from forespell.plans.prefixes import (
    DEFAULT_K,
    FEW_PREFIXES,
    HOT_COPIES,
    QueryProfile,
    distinct_prefixes,
    hand_back,
    profile_queries,
    with_prefix,
)


def complete_stream(
    queries: DataFrame,
    table: DataFrame,
    max_len: int | None = None,
    k: int | Column = 5,
    case_sensitive: bool = True,
) -> DataFrame:
    """The stream with ``completions``, an array of up to ``k`` entries.

    A stream-static left join with a completion table; batch queries work too.
    Every query keeps its row; without a match the array is empty. What the table
    was built for is kept with it: a larger ``k`` is an error, and so is a prefix
    longer than the table's, which ``complete_stream_batch`` answers.
    ``max_len`` may lower the table's own bound; it is needed only for a table
    that does not know it.
    """
    known = table_bounds(table)
    if known is None and max_len is None:
        raise ValueError("this table does not say what it was built for; state max_len")
    if known and max_len is not None and max_len > known[0]:
        raise ValueError(f"the table holds prefixes of up to {known[0]} characters, not {max_len}")
    if known and isinstance(k, int) and k > known[1]:
        raise ValueError(f"the table holds {known[1]} completions of a prefix, not {k}")
    reach = known[0] if max_len is None else max_len
    wanted = F.lit(k) if isinstance(k, int) else k
    asked = F.coalesce(F.col("q"), F.lit(""))
    prefix = asked if case_sensitive else fold(asked)
    answers = table.select(F.col("prefix").alias("_prefix"), "completions")
    joined = queries.join(answers, prefix == F.col("_prefix"), "left")
    nothing = F.array().cast(answers.schema["completions"].dataType)
    found = F.coalesce(F.slice("completions", F.lit(1), wanted), nothing)
    checked = F.when(F.length(asked) > reach, F.raise_error("a prefix is longer than those of the table"))
    if known:
        checked = checked.when(wanted > known[1], F.raise_error("more completions are asked than the table holds"))
    return joined.select(*[F.col(c) for c in queries.columns], checked.otherwise(found).alias("completions"))


def complete_stream_batch(
    queries: DataFrame,
    dictionary: DataFrame | None,
    path: str,
    case_sensitive: bool = True,
    ties: str = "last",
    heavy_from: int | None = None,
    table: DataFrame | None = None,
    keep_unmatched: bool = False,
    as_json: bool = False,
) -> DataStreamWriter:
    """Answer every micro-batch, for prefixes of any length.

    The stream has ``qid, q, k``; a missing ``k`` is 10. With a completion ``table`` it
    answers what it was built for, and the dictionary the rest: longer prefixes and larger
    ``k``; together they hold every query once. Without a dictionary such a query is an
    error. Each micro-batch is measured first: a stored table is read only where its
    prefixes are, and a prefix that most of its rows share is looked up once and spread when
    it is handed back. ``keep_unmatched`` keeps a row for a
    query without a match, ``as_json`` writes suggestion documents (and keeps all).
    The answers of micro-batch ``n`` go to ``path/batch_id=n``, overwritten if the
    batch is repeated after a failure, so each is stored once. Set the trigger
    and checkpoint on the returned writer and start it; read the answers back
    from ``path``.
    """
    keep = keep_unmatched or as_json
    bounds = table_bounds(table) if table is not None else None
    if table is not None and (bounds is None or ties != "last"):
        raise ValueError("the table must say what it was built for, and knows no other ties than 'last'")

    if dictionary is None and table is None:
        raise ValueError("there must be a dictionary or a table")

    def answer(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("k", F.coalesce("k", F.lit(DEFAULT_K)))
        # measured, reduced and answered: read the source once for all three
        batch.persist()
        try:
            rest = batch
            parts = []
            if bounds:
                fits = (F.length(F.coalesce("q", F.lit(""))) <= bounds[0]) & (F.col("k") <= bounds[1])
                parts.append(complete_from_table(batch.filter(fits), table, case_sensitive, keep))
                rest = batch.filter(~fits)
            if not bounds or not rest.isEmpty():
                if dictionary is None:
                    raise ValueError(f"the table holds {bounds[1]} completions of prefixes of up to {bounds[0]} characters; a query asks for more")
                parts.append(complete_batch(dictionary, rest, case_sensitive, ties, keep, heavy_from=heavy_from))
            completions = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            if as_json:
                completions = suggestions_json(completions)
            completions.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return queries.writeStream.foreachBatch(answer)


def complete_from_table(
    queries: DataFrame,
    table: DataFrame,
    case_sensitive: bool = True,
    keep_unmatched: bool = False,
    hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """``qid, rank, text, weight`` of ``qid, q, k`` from a completion table that was built for them.

    The distinct prefixes are measured; their lengths, their range and, if they are few, the
    prefixes themselves become conditions of the scan, so of a stored table only their
    folders and row groups are read. As long as they can be broadcast the table is not
    shuffled.
    """
    asked = with_prefix(queries, case_sensitive)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    wanted = distinct.select("prefix", "k")
    once = F.broadcast(wanted) if profile.broadcasts() == 1 else wanted
    found = _part_of_table(table, distinct, profile).join(once, "prefix")
    flat = found.select("prefix", F.posexplode(F.slice("completions", F.lit(1), F.col("k"))).alias("_at", "entry"))
    answers = flat.select("prefix", (F.col("_at") + 1).alias("rank"), "entry.text", "entry.weight")
    returned = hand_back(asked, answers, distinct, profile, "left" if keep_unmatched else "inner", hot_copies)
    kept = F.col("rank") <= F.col("k")
    return returned.filter(kept | F.col("rank").isNull() if keep_unmatched else kept).select("qid", "rank", "text", "weight")


def _part_of_table(table: DataFrame, distinct: DataFrame, profile: QueryProfile) -> DataFrame:
    """The rows of the table among which the prefixes are, by conditions that reach a stored scan."""
    prefix = F.col("prefix")
    if not profile.lengths:
        return table.filter(F.lit(False))
    if "prefix_length" in table.columns:
        table = table.filter(F.col("prefix_length").isin(*profile.lengths))
    if profile.first:
        up_to_last = (prefix < F.lit(profile.last)) | prefix.startswith(F.lit(profile.last))
        table = table.filter((prefix >= F.lit(profile.first)) & up_to_last)
    if profile.prefixes <= FEW_PREFIXES:
        table = table.filter(prefix.isin(*[r[0] for r in distinct.select("prefix").collect()]))
    return table.select("prefix", "completions")
