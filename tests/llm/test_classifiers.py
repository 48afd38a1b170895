"""Quality and toxicity models: held-out accuracy and odd inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from forespell.llm import quality, queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("query", "label", "least"), [(queries.op7_quality, "quality", 0.97), (queries.op8_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    got = query(spark, SF_DIR).join(queries.table(spark, SF_DIR, "labels"), "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 50 and right >= least


def test_every_document_once(spark):
    n = queries.table(spark, SF_DIR, "documents").count()
    for query in (queries.op7_quality, queries.op8_toxicity):
        got = query(spark, SF_DIR)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        assert got.count() == n and got.filter("score < 0 or score > 1 or score is null").count() == 0


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, documents, module, label):
    rows = [(1, None), (2, ""), (3, "fine words here"), (None, "no id"), (3, "fine words here"), (4, "x " * 400_000), (5, "BAD!! " * 30)]
    labels = spark.createDataFrame([(1, 1, "t"), (3, 1, "t"), (3, 0, "t"), (5, 0, "t"), (None, 1, "t"), (2, None, "t")], f"doc_id long, {label} int, text string")
    model = module.train(documents(rows), labels, F.lit(True))
    assert module.score(documents(rows), model).count() == len(rows)
    assert module.score(documents([]), model).count() == 0
    assert module.accepted(documents(rows), model).columns == documents([]).columns
    for some in (labels.filter("false"), labels.filter(f"{label} = 0")):
        model = module.train(documents(rows), some, F.lit(True))
        scores = {round(r["score"], 6) for r in module.score(documents(rows), model).collect()}
        assert len(scores) == 1
    assert module.train(documents([]), labels, F.lit(True)) is not None
