"""Dictionary preparation: folding, order, duplicates, positions and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forespell.functions import byte_length, fold, match_key
from forespell.session import cut_lineage

# Equal rows that may sit in one partition of a sort.
COPIES_PER_CHUNK = 1_000_000

# monotonically_increasing_id() keeps the partition number above this bit and the
# row number inside the partition below it.
_ROW_BITS = 33


def with_folded(dictionary: DataFrame) -> DataFrame:
    """Store the folded text once, so that no query has to fold the dictionary."""
    return dictionary.withColumn("folded", fold("text"))


def spread_copies(df: DataFrame) -> DataFrame:
    """The same rows with ``_chunk``, so that no more than ``COPIES_PER_CHUNK`` are alike.

    Equal rows cannot be told apart by a range exchange and would all meet in
    one partition, however many there are. They are counted first and numbered
    in chunks, which the exchange can separate.
    """
    size = F.lit(COPIES_PER_CHUNK)
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    last_chunk = F.floor((F.col("_copies") - 1) / size).cast("bigint")
    few = counted.filter(F.col("_copies") <= size).withColumn("_chunk", F.lit(0).cast("bigint"))
    # the chunks of a row part before its copies are made, so no task makes them all
    many = counted.filter(F.col("_copies") > size)
    many = many.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    chunked = few.unionByName(many.repartition(*df.columns, "_chunk"))
    left = F.least(size, F.col("_copies") - F.col("_chunk") * size)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), left))
    return chunked.withColumn("_copy", copies).drop("_copy", "_copies")


def sort_dictionary(
    dictionary: DataFrame, case_sensitive: bool = True, unique: bool = False
) -> DataFrame:
    """Byte order of the text (or folded text), then text, then weight: a total order.

    ``unique=True`` promises that no two rows are equal and saves the counting
    of copies.
    """
    order = _sort_order(dictionary, case_sensitive)
    if unique:
        return dictionary.orderBy(*order)
    return spread_copies(dictionary).orderBy(*order, "_chunk").drop("_chunk")


def _sort_order(dictionary: DataFrame, case_sensitive: bool) -> list[Column]:
    order = [F.col("text"), F.col("weight")]
    return order if case_sensitive else [match_key(dictionary, False), *order]


def dedup(dictionary: DataFrame, case_sensitive: bool = True, on_duplicate: str = "min") -> DataFrame:
    """One entry per text (or per folded text).

    The smallest weight is kept by default; ``max`` and ``sum`` are the
    alternatives. Among spellings that fold alike, ``min`` keeps the smallest
    spelling with its weight, ``max`` the heaviest entry (then the smallest
    spelling), and ``sum`` the smallest spelling with the total weight.
    """
    if on_duplicate not in ("min", "max", "sum"):
        raise ValueError(f"on_duplicate must be min, max or sum, not {on_duplicate!r}")
    if case_sensitive:
        return dictionary.groupBy("text").agg(getattr(F, on_duplicate)("weight").alias("weight"))
    groups = dictionary.groupBy(match_key(dictionary, False).alias("folded"))
    if on_duplicate == "sum":
        return groups.agg(F.min("text").alias("text"), F.sum("weight").alias("weight")).select(
            "text", "weight", "folded"
        )
    if on_duplicate == "min":
        best = F.min(F.struct("text", "weight"))
    else:
        best = F.min(F.struct((-F.col("weight")).alias("heaviest"), "text", "weight"))
    return groups.agg(best.alias("best")).select("best.text", "best.weight", "folded")


def row_counts(dictionary: DataFrame, case_sensitive: bool = True) -> DataFrame:
    """``rows_read`` and ``rows_unique`` in one row."""
    per_key = dictionary.groupBy(match_key(dictionary, case_sensitive).alias("key")).agg(
        F.count("*").alias("copies")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_read"), F.count("*").alias("rows_unique")
    )


def input_stats(dictionary: DataFrame) -> DataFrame:
    """Number of entries, total text bytes and the largest weight, in one row."""
    return dictionary.agg(
        F.count("*").alias("entries"),
        F.coalesce(F.sum(byte_length("text").cast("bigint")), F.lit(0)).alias("text_bytes"),
        F.max("weight").alias("max_weight"),
    )


def number_rows(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sort ``df`` across partitions and add ``part`` and ``row``.

    ``row`` is the 0-based place inside partition ``part``. The sorted rows are
    checkpointed: range bounds are sampled, so a second evaluation could cut the
    partitions elsewhere and the two results would not belong together.
    """
    packed = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("_packed", packed))
    return placed.select(
        *df.columns,
        F.shiftrightunsigned("_packed", _ROW_BITS).alias("part"),
        F.col("_packed").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("row"),
    )


def partition_offsets(numbered: DataFrame, counted: Column) -> DataFrame:
    """``part, before``: how many counted rows lie in earlier partitions.

    One row per partition of the sort, hence small enough for one task and for
    a broadcast whatever the size of the data.
    """
    per_part = numbered.groupBy("part").agg(F.sum(counted.cast("bigint")).alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))


def with_position(
    dictionary: DataFrame, case_sensitive: bool = True, unique: bool = True
) -> DataFrame:
    """Add ``pos``, the 0-based place in sorted order.

    One range exchange; every partition numbers its own rows and adds the size
    of the partitions before it, so no prefix, however common, ends up in one
    task. ``unique=False`` does the same for a dictionary with equal rows.
    """
    order = _sort_order(dictionary, case_sensitive)
    if unique:
        numbered = number_rows(dictionary, order)
    else:
        numbered = number_rows(spread_copies(dictionary), [*order, F.col("_chunk")])
    offsets = partition_offsets(numbered, F.lit(1))
    return numbered.join(F.broadcast(offsets), "part").select(
        *dictionary.columns, (F.col("before") + F.col("row")).alias("pos")
    )


def range_argmax(positioned: DataFrame, first: int, last: int) -> DataFrame:
    """The heaviest entry with ``first <= pos <= last``; the later one on a tie."""
    inside = positioned.filter(F.col("pos").between(first, last))
    return inside.orderBy(F.desc("weight"), F.desc("pos")).limit(1)
