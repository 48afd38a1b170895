"""Nearest neighbours: recall against brute force, exact scores, ties and odd rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from forespell.llm import neighbours, queries

SF_DIR = "/root/testdata/sf0.01"


def brute(ids, vectors, k):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = (vectors * vectors[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def result(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_on_the_tables(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 200)
    monkeypatch.setattr(neighbours, "GROUP", 10)
    rows = queries.table(spark, SF_DIR, "embeddings").orderBy("vec_id").toPandas()
    want = brute(rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float), 20)
    got = result(queries.op4_neighbours(spark, SF_DIR))
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.95
    assert all(abs(dict(want[q]).get(i, s) - s) < 1e-12 for q in want for i, s in got[q])


def test_inner_products_of_unequal_norms(spark):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(3000, 16)) * draw.uniform(0.1, 5, size=(3000, 1))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got, want = result(neighbours.nearest(df, F.col("id") % 20 == 0)), brute(np.arange(3000), vectors, 20)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (20 * len(want)) >= 0.9


def test_ties_and_odd_rows(spark):
    one, two = [1.0, 0.0], [0.0, 2.0]
    rows = [(k, one) for k in range(60)] + [(100, two), (101, None), (102, []), (103, [0.0, 0.0]), (104, [1.0, None]), (105, [float("nan"), 1.0]), (106, [float("inf"), 1.0]), (None, one), (20, one), (120, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, block int, group int")
    got = result(neighbours.nearest(df, F.col("id") % 20 == 0))
    assert set(got) == {0, 20, 40, 100}
    assert [i for i, _ in got[0]] == list(range(1, 21)) and [i for i, _ in got[40]] == list(range(20))
    assert got[100] == [(k, 0.0) for k in range(20)]
    assert result(neighbours.nearest(df.filter("vec_id > 90"), F.col("id") % 20 == 0)) == {}
    assert neighbours.nearest(df.filter("false"), F.col("id") % 20 == 0).count() == 0


def test_recall_of_a_full_block():
    """Clustered vectors of unequal norms, as many as a block holds and more."""
    draw = np.random.default_rng(7)
    for n, clusters, spread in ((neighbours.BLOCK, 50, 0.5), (neighbours.BLOCK, 1000, 0.3), (20_000, 10, 1.5)):
        vectors = (draw.normal(size=(clusters, 64))[draw.integers(0, clusters, n)] + spread * draw.normal(size=(n, 64))) * draw.uniform(0.5, 1.5, size=(n, 1))
        index = neighbours.Index(vectors, float(np.sqrt((vectors**2).sum(axis=1)).max()))
        found = index.search(vectors[:40], lambda q: np.array([q]), 20)
        hits = 0
        for q, (at, scores) in enumerate(found):
            exact = vectors @ vectors[q]
            exact[q] = -np.inf
            assert np.allclose(scores, exact[at])
            hits += len(set(at[np.argsort(-scores)[:20]].tolist()) & set(np.argsort(-exact)[:20].tolist()))
        assert hits / (20 * 40) >= 0.98
