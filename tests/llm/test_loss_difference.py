"""Cross-entropy difference against plain counting."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from forespell.llm import loss_difference as lm
from forespell.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "</s>"]


def brute(documents, target):
    aimed, behind = [tokens(t) for t in target], [tokens(t) for t in documents]
    pairs = lambda x: list(zip(["<s>", *x[:-1]], x, strict=True))
    words = [Counter(w for x in side for w in x) for side in (aimed, behind)]
    both = [Counter(p for x in side for p in pairs(x)) for side in (aimed, behind)]
    sizes = [sum(c.values()) for c in words]
    nt, scale = max(sizes[0], 1), max(sizes[0], 1) / sizes[1]
    out = []
    for x in behind:
        own, own_pairs, total = Counter(x), Counter(pairs(x)), 0.0
        count = lambda w: (words[0][w], scale * (words[1][w] - own[w]))  # noqa: B023, E731
        for v, w in pairs(x):
            a, b = count(w)
            q = (a + b + lm.FLOOR) / (2 * nt + 1)
            p = [(c + lm.KAPPA * q) / (nt + lm.KAPPA) for c in (a, b)]
            of_v = (len(aimed), scale * (len(behind) - 1)) if v == "<s>" else count(v)
            of_pair = (both[0][v, w], scale * (both[1][v, w] - own_pairs[v, w]))
            losses = [-math.log((of_pair[k] + lm.MU * p[k]) / (of_v[k] + lm.MU)) for k in (0, 1)]
            total += losses[0] - losses[1]
        out.append((len(x), total / len(x)))
    return out


@pytest.mark.parametrize("share", [1e-4, 0.02])
def test_query_against_plain_counting(spark, monkeypatch, share):
    monkeypatch.setattr(lm, "HEAVY", share)
    docs = queries.table(spark, SF_DIR, "documents").orderBy("doc_id").collect()
    target = [r["text"] for r in queries.table(spark, SF_DIR, "conversations").collect()]
    got = sorted(map(tuple, queries.op5_loss_difference(spark, SF_DIR).collect()))
    want = brute([r["text"] for r in docs], target)
    assert [g[:2] for g in got] == [(r["doc_id"], n) for r, (n, _) in zip(docs, want, strict=True)]
    assert [g[2] for g in got] == pytest.approx([s for _, s in want], abs=1e-5)


def test_blocks_keep_whole_hashes():
    word = np.array([9, 9, 9, 1 << 63], np.uint64)
    context = np.array([5, 5 + (1 << 32), 5, 5 + (1 << 63)], np.uint64)
    doc = np.array([7, 7, 80_000, 7], np.uint64)
    for own in (np.zeros(4, np.uint32), np.array([1, 70_000, 1, 2], np.uint32)):
        side, *got = lm._unpack(lm._pack(word, context, doc, own, 1))
        assert side == 1 and sorted(zip(*(g.tolist() for g in got), strict=True)) == sorted(zip(*(x.tolist() for x in (word, context, doc, own)), strict=True))


def test_parts_follow_the_tokens(spark, documents, prose, monkeypatch):
    rows = [(k, prose(k, 30)) for k in range(40)]
    docs = documents(rows)
    target = spark.createDataFrame([(prose(99, 50),)], "text string")
    few = {r["doc_id"]: r["score"] for r in lm.score(docs, target).collect()}
    monkeypatch.setattr(lm, "PART_TOKENS", 20)
    plan = lm.score(docs, target)
    assert plan.rdd.getNumPartitions() > 40
    assert {r["doc_id"]: r["score"] for r in plan.collect()} == pytest.approx(few, abs=1e-5)


def test_odd_rows(spark, documents, prose):
    rows = [(1, None), (2, ""), (None, "the river stone"), (3, "the river stone"), (3, "the river stone"), (4, "line " * 100_000), (5, prose(1, 50))]
    target = spark.createDataFrame([("the river stone light", 1), (None, 2), ("the river", 3)], "text string, doc_id long")
    got = sorted([tuple(r) for r in lm.score(documents(rows), target).collect()], key=str)
    want = brute([t for _, t in rows], ["the river stone light", None, "the river"])
    expected = sorted([(i, n, s) for (i, _), (n, s) in zip(rows, want, strict=True)], key=str)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert sorted(g[2] for g in got) == pytest.approx(sorted(e[2] for e in expected), abs=1e-4)
    assert lm.score(documents([]), target).count() == 0
    assert lm.score(documents(rows), target.filter("false")).count() == len(rows)
