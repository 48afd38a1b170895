"""Whitening: against numpy's eigenvectors, exact sums, and odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from forespell.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, k=4):
    """For each id the exact deviation and the whitened components, by numpy on the whole table."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [sum(col) for col in zip(*{tuple(x) for _, x in kept}, strict=True)]
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out[i] = (n, deviation, ((np.array(x) - fit.mean(axis=0)) @ vectors[:, order]) / np.sqrt(values[order]), values[order] / values.sum())
    return out


def check(got, want):
    signs = {}
    assert {r["vec_id"] for r in got} == set(want)
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"]]
        c = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(whitened[c]), abs=1e-7)
        if abs(whitened[c]) > 1e-3:
            assert signs.setdefault(c, np.sign(r["whitened"] * whitened[c])) == np.sign(r["whitened"] * whitened[c])
        assert 0 <= r["identity_error"] <= 1e-9


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, SF_DIR, "embeddings").collect()]
    got = queries.op13_whitening(spark, SF_DIR).collect()
    assert len(got) == 4 * len(rows)
    check(got, brute(rows))


def test_factor_and_rotations():
    draw = np.random.default_rng(2)
    for size, rank in ((1, 1), (2, 2), (7, 7), (8, 3), (33, 20)):
        a = draw.normal(size=(size, rank)) * draw.uniform(1e-3, 1e3, size=(1, rank))
        scatter = a @ a.T
        factor, pivots = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor[:, : factor.shape[1]] @ factor.T, scatter[pivots][:, pivots], rtol=1e-9, atol=1e-9 * scatter.max())
        assert np.allclose(np.triu(factor[: factor.shape[1]], 1), 0) and (np.diff(np.diagonal(factor)) <= 1e-9 * factor.max()).all()
        values, vectors = whitening.eigenpairs(scatter)
        want = np.linalg.eigvalsh(scatter)[::-1]
        assert np.allclose(values[:rank], want[: len(values)][:rank], rtol=1e-8, atol=1e-10 * want[0])
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-6)
        assert np.allclose(scatter @ vectors[:, 0], values[0] * vectors[:, 0], rtol=1e-8, atol=1e-8 * values[0])
    assert whitening.eigenpairs(np.zeros((3, 3)))[1].shape == (3, 0)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, [2.0], 0.5) for i, v in rows], "vec_id long, embedding array<double>, n int, x array<double>, whitened double")


def test_odd_rows_copies_and_ties(spark):
    draw = np.random.default_rng(3)
    rows = [(k, (draw.normal(size=5) * [9, 4, 2, 1, 0.5] + [1e6, 0, -3, 0, 7]).tolist()) for k in range(120)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # copies weigh nothing
    odd = [(1, None), (2, []), (3, [1.0, None, 1.0, 1.0, 1.0]), (4, [float("nan")] * 5), (5, [float("inf")] + [0.0] * 4), (6, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, rows + [(i + 5000, v) for i, v in odd]).repartition(7)).collect()
    check(got, brute(rows))
    assert whitening.whiten(frame(spark, [*rows, (None, rows[5][1]), (7, rows[5][1])])).filter("vec_id is null").count() == 4


def test_low_rank_and_empty_tables(spark):
    line = [(k, [float(k), 2.0 * k, 5.0]) for k in range(9)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 9 and got[0]["explained"] == pytest.approx(1)
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_numbers_near_the_ends(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [3.0, 2.0]), (3, [1e12, 2.5])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) >= 4 and all(r["deviation"] is None for r in got if r["vec_id"] in (0, 1)) and all(math.isfinite(r["whitened"]) for r in got)
