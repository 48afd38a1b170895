"""Query tables: ``qid BIGINT, q STRING, k INT``."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How many completions a query gets when it does not say.
LINE_K = 5
REQUEST_K = 10

_SCHEMA = "qid BIGINT, q STRING, k INT"


def queries_from(spark: SparkSession, prefixes: Iterable[str], k: int = LINE_K) -> DataFrame:
    """Queries from prefixes known on the driver; ``qid`` is their position."""
    q = list(prefixes)
    columns = [pa.array(range(len(q)), pa.int64()), pa.array(q, pa.string()), pa.array([k] * len(q), pa.int32())]
    return spark.createDataFrame(pa.table(columns, names=["qid", "q", "k"]), _SCHEMA)


def read_queries(spark: SparkSession, path: str | list[str], k: int = LINE_K) -> DataFrame:
    """One prefix per line; an empty line asks for the heaviest entries overall."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.monotonically_increasing_id().alias("qid"), F.col("value").alias("q"), F.lit(k).alias("k")
    )


def stream_queries(spark: SparkSession, path: str, k: int = LINE_K) -> DataFrame:
    """The streaming form of ``read_queries``: every new file brings more lines."""
    lines = spark.readStream.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").alias("q"), F.lit(k).alias("k"))


def split_queries(
    df: DataFrame, default_k: int = REQUEST_K, min_chars: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Fill in defaults; return the answerable queries and the rest with a ``reason``.

    A missing ``q`` asks for everything, a missing ``k`` gets ``default_k``.
    Queries with ``k`` below 1 or fewer than ``min_chars`` characters are
    refused.
    """
    filled = df.withColumns(
        {"q": F.coalesce("q", F.lit("")), "k": F.coalesce("k", F.lit(default_k)).cast("int")}
    )
    reason = F.when(F.col("k") < 1, "k below 1").when(F.length("q") < min_chars, "prefix too short")
    judged = filled.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).drop("reason")
    return good, judged.filter(F.col("reason").isNotNull())


def normalise_queries(df: DataFrame, default_k: int = REQUEST_K, min_chars: int = 0) -> DataFrame:
    """The answerable queries of ``split_queries``."""
    return split_queries(df, default_k, min_chars)[0]
