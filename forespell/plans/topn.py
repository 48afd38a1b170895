"""Top-n rows of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# With a literal bound Spark cuts every group to n rows before the exchange, so
# the task that finishes a group gets at most n rows per input partition. Where
# that may pass this many rows, groups are first merged in parts, in a tree.
ROWS_PER_TASK = 1_000_000
# Input partitions are taken to be no more than this.
INPUT_PARTITIONS = 1 << 20
MERGE_FROM_N = 100

# Spark pushes no group limit above 1000 rows (spark.sql.optimizer.windowGroupLimitThreshold).
# Beyond this many rows, groups are cut by counts instead.
LIMIT_PUSHED = 1_000

# Weights below 10 ** EXACT_DIGITS have a bucket of their own.
EXACT_DIGITS = 2


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= F.lit(n))


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    merge_from: int = MERGE_FROM_N,
) -> DataFrame:
    """The first ``n`` rows of each group with their 1-based ``rank``.

    ``order`` must be total, so that the result does not depend on how the rows
    are spread. Above ``LIMIT_PUSHED`` rows nothing is cut before the exchange;
    ``within_reach`` does that.
    """
    if merge_from <= n <= LIMIT_PUSHED:
        df = df.withColumn("_part", F.spark_partition_id())
        for parts in merge_tree(n):
            df = df.withColumn("_part", F.col("_part") % parts)
            df = _ranked(df, [*keys, "_part"], order, n, rank).drop(rank)
        df = df.drop("_part")
    return _ranked(df, keys, order, n, rank)


def merge_tree(n: int) -> list[int]:
    """Numbers of parts, falling, so that no task merges more than ROWS_PER_TASK rows of a group.

    Each level merges ``ROWS_PER_TASK / n`` parts of the level before into one.
    """
    fan = max(2, ROWS_PER_TASK // n)
    levels, parts = [], INPUT_PARTITIONS
    while parts > fan:
        parts = -(-parts // fan)
        levels.append(parts)
    return levels or [1]


def weight_bucket(weight: Column) -> Column:
    """A whole number that never falls while the weight grows: its number of digits and the first two.

    Twenty digits make 1,800 buckets at most. Weights below 100 have one each; all
    negative weights share one.
    """
    digits = weight.cast("string")
    return F.when(weight < 0, F.lit(0)).otherwise(F.length(digits) * 100 + F.left(digits, F.lit(EXACT_DIGITS)).cast("int"))


def reach_of_first(rows: DataFrame, key: str, tie: Column, n: Column, tie_desc: bool = True) -> DataFrame:
    """``key, _bucket, _tie``: how far down the order the first ``n`` rows of each group can lie.

    Rows are counted by weight bucket and, where a bucket is one weight, by ``tie``,
    a column that never rises (``tie_desc``) or falls along the order among equal
    weights. The bound is the first count, heaviest bucket first, with which ``n`` rows
    are together; a group with fewer rows gets its last. The counts are summed where
    the rows are, so the aggregate is small however large a group is.
    """
    bucket = weight_bucket(F.col("weight"))
    alone = bucket.between(1, 100 * (EXACT_DIGITS + 1) - 1)
    placed = rows.select(key, n.alias("_wanted"), bucket.alias("_bucket"), F.when(alone, tie).otherwise(F.lit("")).alias("_tie"))
    counted = placed.groupBy(key, "_bucket", "_tie").agg(F.count("*").alias("_rows"), F.max("_wanted").alias("_wanted"))
    order = [F.desc("_bucket"), F.desc("_tie") if tie_desc else F.asc("_tie")]
    earlier = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    last = F.max_by(F.struct("_bucket", "_tie"), "_before").alias("_last")
    return counted.filter(F.col("_before") < F.col("_wanted")).groupBy(key).agg(last).select(key, "_last._bucket", "_last._tie")


def within_reach(
    rows: DataFrame, key: str, tie: Column, n: Column, tie_desc: bool = True, small: bool = True
) -> DataFrame:
    """``rows`` without those that cannot be among the first ``n`` of their group.

    What is left of a group is ``n`` rows and the rest of one bucket. ``small`` says that
    the groups can be broadcast; otherwise a join that adaptive execution can split
    holds the rows against their bound.
    """
    reach = reach_of_first(rows, key, tie, n, tie_desc)
    held = rows.join(F.broadcast(reach) if small else reach.hint("shuffle_merge"), key)
    bucket = weight_bucket(F.col("weight"))
    level = (tie >= F.col("_tie")) if tie_desc else (tie <= F.col("_tie"))
    level = level | (F.col("_bucket") >= 100 * (EXACT_DIGITS + 1)) | (F.col("_bucket") == 0)
    return held.filter((bucket > F.col("_bucket")) | ((bucket == F.col("_bucket")) & level)).drop("_bucket", "_tie")
