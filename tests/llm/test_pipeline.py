"""The pipeline's stages on the smallest tables, each against its own rule."""

from __future__ import annotations

import re

import corpus_pipeline
import __spark_entry__ as driver
from forespell.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = driver.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    labels = {r["doc_id"]: r for r in queries.table(spark, SF_DIR, "labels").collect()}
    kept = [{r["doc_id"] for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == before.columns
        kept.append({r["doc_id"] for r in docs.collect()})
        assert kept[-1] <= kept[-2] and docs.count() == len(kept[-1])
    known = [d for d in kept[0] if d in labels]
    good = [d for d in known if labels[d]["quality"] == 1]
    assert sum(d in kept[1] for d in good) >= 0.97 * len(good)
    assert sum(d not in kept[1] for d in known if labels[d]["quality"] == 0) >= 0.8 * (len(known) - len(good))
    texts = {r["doc_id"]: " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in docs.collect()}
    items = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    assert not [d for d, t in texts.items() if any(i in t for i in items)]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in out.collect()} == kept[-1]
    assert out.filter("not decoded or size(nbest_scores) != 3 or n_pieces != size(ids)").isEmpty()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "ids", "n_pieces", "nbest_scores", "decoded"] and out.count() > 0
