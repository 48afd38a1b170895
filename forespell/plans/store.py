"""Stored dictionaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.functions import fold, match_key


def save_dictionary(dictionary: DataFrame, path: str, case_sensitive: bool = True) -> None:
    """Write the dictionary sorted by its match key.

    Sorted files make a prefix touch few row groups: the pushed-down condition
    skips the others by their minimum and maximum. The text column is written
    front-coded, which suits neighbours that share a prefix. A case-insensitive
    dictionary also stores the folded text.
    """
    if case_sensitive:
        rows, order = dictionary.select("text", "weight"), ["text"]
    else:
        rows = dictionary.select("text", "weight", match_key(dictionary, False).alias("folded"))
        order = ["folded", "text"]
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary#text", "false")
        .option("parquet.enable.dictionary#folded", "false")
        .parquet(path)
    )


def load_dictionary(spark: SparkSession, path: str, case_sensitive: bool = True) -> DataFrame:
    """Open a stored dictionary with the weight type it was stored with.

    A case-insensitive reader needs ``folded``. If the files do not have it, it is
    computed while reading: right, but without pruning.
    """
    stored = spark.read.parquet(path)
    if case_sensitive:
        return stored.select("text", "weight")
    return stored if "folded" in stored.columns else stored.withColumn("folded", fold("text"))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished; a lost job leaves no success marker."""
    try:
        spark.read.text(f"{path.rstrip('/')}/_SUCCESS")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def source_fingerprint(spark: SparkSession, sources: list[str]) -> str:
    """A name for the present state of some files or folders: their paths, sizes and times.

    Only the listing is read, not the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sources)
    seen = files.select(F.xxhash64("path", "modificationTime", "length").alias("h"), "length")
    row = seen.agg(F.count("*").alias("n"), F.sum("length").alias("size"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return f"{row['n']} {row['size']} {row['x']} {row['s']}"


def _kept_fingerprint(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.text(f"{path.rstrip('/')}/_source").first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    mode: str = "reuse",
    case_sensitive: bool = True,
    sources: list[str] | None = None,
) -> DataFrame:
    """Open the stored dictionary, or build and store it first.

    ``mode='reuse'`` takes whatever was stored completely, without asking whether the data
    behind it changed; ``mode='check'`` takes it if the files ``sources`` are those it was built
    from, which is kept with it; ``mode='rebuild'`` always builds again.
    """
    if mode not in ("reuse", "check", "rebuild"):
        raise ValueError(f"mode must be 'reuse', 'check' or 'rebuild', not {mode!r}")
    if mode == "check" and not sources:
        raise ValueError("mode='check' needs the sources")
    # before the build: a change during it is found the next time
    present = source_fingerprint(spark, sources) if sources else None
    stored = mode != "rebuild" and is_complete(spark, path)
    if stored and (mode == "reuse" or _kept_fingerprint(spark, path) == present):
        return load_dictionary(spark, path, case_sensitive)
    save_dictionary(build(), path, case_sensitive)
    if present:
        spark.range(1).select(F.lit(present).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/_source")
    return load_dictionary(spark, path, case_sensitive)
