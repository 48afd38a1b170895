"""The registered queries of this subpackage: operators with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.llm import conversation_repair, decontaminate, loss_difference, near_dup, neighbours, page_text, pieces, quality, sql, substring_dedup, token_files, toxicity, warc, whitening
from forespell.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, similarity=0.85)


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return page_text.extract(pages, page_text.train(pages))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op5_loss_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by how near they are to the language of the conversations."""
    return loss_difference.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages")).filter("gap_end is null")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"), fold(3) != 1)
    scored = quality.score(documents, model)
    return scored.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), fold(4) != 2)
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), n=3)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.deduplicated(table(spark, sf_dir, "documents"), size=13))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.digest(conversations, conversation_repair.repair(conversation_repair.damage(conversations)))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=4)


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    return {name: _shipped(made) for name, made in globals().items() if name.startswith("op") and callable(made)}


def all_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express the operator and finishes on whole tables."""
    return sql.all_sql()
