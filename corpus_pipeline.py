"""From documents to token ids: five stages, each written as Parquet and reread by the next.

Every stage reads all rows that its predecessor kept. A stage that filters returns the
columns of ``documents`` (extra columns pass through); the last returns ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forespell.llm import decontaminate, near_dup, pieces, quality, toxicity
from forespell.llm.components import written
from forespell.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts (score of 0.5 or more)."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return quality.accepted(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity of 0.8 or more)."""
    ship(spark)
    return near_dup.deduplicated(docs, words_per_shingle=5, similarity=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, the scores of the three best segmentations, and whether the ids decode to the text."""
    ship(spark)
    encoded = pieces.encode(docs, n=3)
    return encoded.select("doc_id", "ids", F.size("ids").alias("n_pieces"), F.col("nbest.score").alias("nbest_scores"), "decoded")


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs


#: SQL cannot express trained models, sketches and piece lattices; tests/llm compares stages with brute force.
ORACLE_SQL = None
