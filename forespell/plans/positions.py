"""A stored dictionary that knows its positions.

The files are sorted and do not overlap, and a manifest has one row for each: how many
entries it holds, how many lie before it, its first and its last key. The position of an
entry is what lies before its file plus its place there, so nothing is sorted or numbered
again; and a range, a count or a common extension of one prefix is read off the manifest
and the two files at most in which its matches begin and end.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.functions import common_prefix, fold_literal, match_key


class Positioned(NamedTuple):
    """A stored dictionary: its folder, the manifest, the column prefixes are compared with."""

    spark: SparkSession
    path: str
    manifest: DataFrame
    key: str

    def entries(self) -> DataFrame:
        """``text, weight, pos`` (and ``folded``), straight from the files.

        The manifest has a row for each file, so it is joined by broadcast.
        """
        rows = self.spark.read.parquet(f"{self.path}/entries")
        placed = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("_row"))
        before = F.broadcast(self.manifest.select("file", "before"))
        return placed.join(before, "file").select(*rows.columns, (F.col("before") + F.col("_row")).alias("pos"))


def save_positioned(dictionary: DataFrame, path: str, case_sensitive: bool = True, files: int | None = None) -> None:
    """Store the dictionary sorted, with its manifest. ``files`` is their number at most.

    Equal rows are allowed; those that are equal in all columns share a file.
    """
    path = path.rstrip("/")
    columns = [F.col("text"), F.col("weight")]
    order = ["text", "weight"]
    if not case_sensitive:
        columns.append(match_key(dictionary, False).alias("folded"))
        order = ["folded", *order]
    rows = dictionary.select(*columns)
    ranged = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    (
        ranged.sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 0)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary#text", "false")
        .option("parquet.enable.dictionary#folded", "false")
        .parquet(f"{path}/entries")
    )
    spark, key = dictionary.sparkSession, order[0]
    stored = spark.read.parquet(f"{path}/entries")
    # folded in the files: one key is enough to order them, but for files that share one
    ends = [F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"), F.min(F.struct(*order)).alias("start")]
    held = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(*ends).coalesce(1)
    held.write.mode("overwrite").parquet(f"{path}/files")
    listed = spark.read.parquet(f"{path}/files").orderBy("start").collect()  # a row for each file
    done, manifest = 0, []
    for row in listed:
        manifest.append((row["file"], row["rows"], done, row["first"], row["last"]))
        done += row["rows"]
    schema = "file STRING, rows BIGINT, before BIGINT, first STRING, last STRING"
    spark.createDataFrame(manifest, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def load_positioned(spark: SparkSession, path: str) -> Positioned:
    """Open what ``save_positioned`` stored."""
    path = path.rstrip("/")
    folded = "folded" in spark.read.parquet(f"{path}/entries").columns
    return Positioned(spark, path, spark.read.parquet(f"{path}/manifest"), "folded" if folded else "text")


class _Ends(NamedTuple):
    below: int
    inside: int
    first: str | None
    last: str | None
    parts: DataFrame


def _ends(stored: Positioned, prefix: str) -> _Ends:
    """What the manifest knows of a prefix, and the entries of the files in which its matches begin and end."""
    wanted = F.lit(prefix)
    starts, stops = F.col("first").startswith(wanted), F.col("last").startswith(wanted)
    below, above = F.col("last") < wanted, (F.col("first") >= wanted) & ~starts
    whole = starts & stops
    known = stored.manifest.agg(
        F.coalesce(F.sum(F.when(below, F.col("rows"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(whole, F.col("rows"))), F.lit(0)).alias("inside"),
        F.min(F.when(whole, F.col("first"))).alias("first"),
        F.max(F.when(whole, F.col("last"))).alias("last"),
        F.collect_list(F.when(~(below | above | whole), F.col("file"))).alias("parts"),
    ).first()
    folder = f"{stored.path}/entries"
    if known["parts"]:
        parts = stored.spark.read.parquet(*[f"{folder}/{name}" for name in known["parts"]])
    else:
        parts = stored.spark.createDataFrame([], f"{stored.key} STRING")
    return _Ends(known["below"], known["inside"], known["first"], known["last"], parts.select(F.col(stored.key).alias("key")))


def _asked(stored: Positioned, prefix: str) -> tuple[str, Column]:
    wanted = prefix if stored.key == "text" else fold_literal(prefix)
    return wanted, F.col("key").startswith(F.lit(wanted))


def stored_prefix_range(stored: Positioned, prefix: str) -> DataFrame:
    """``lb, rb`` as ``prefix_range`` gives them."""
    wanted, matching = _asked(stored, prefix)
    ends = _ends(stored, wanted)
    counted = ends.parts.agg(F.count_if(F.col("key") < F.lit(wanted)).alias("below"), F.count_if(matching).alias("inside"))
    lb = F.lit(ends.below).cast("bigint") + F.col("below")
    return counted.select(lb.alias("lb"), (lb + F.col("inside") + F.lit(ends.inside)).alias("rb"))


def stored_match_count(stored: Positioned, prefix: str) -> DataFrame:
    """``matches`` as ``match_count`` gives it."""
    return stored_prefix_range(stored, prefix).select((F.col("rb") - F.col("lb")).alias("matches"))


def stored_common_extension(stored: Positioned, prefix: str) -> DataFrame:
    """``extension`` as ``common_extension`` gives it."""
    wanted, matching = _asked(stored, prefix)
    ends = _ends(stored, wanted)
    key = F.when(matching, F.col("key"))
    edge = ends.parts.agg(F.min(key).alias("first"), F.max(key).alias("last"))
    first, last = F.least("first", F.lit(ends.first).cast("string")), F.greatest("last", F.lit(ends.last).cast("string"))
    return edge.select(common_prefix(first, last).alias("extension"))
