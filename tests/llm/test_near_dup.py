"""Near duplicates against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np

from forespell.llm import near_dup
from forespell.llm.components import components


def brute(rows, size, similarity):
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            near, every = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * near >= round(100 * similarity) * every and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    low = {}
    for (i, _), g in zip(rows, group, strict=True):
        low[g] = min(low.get(g, i), i)
    return {i: (len(s), low[g]) for (i, _), s, g in zip(rows, sets, group, strict=True)}


def variants(prose, n, seed):
    draw = random.Random(seed)
    base = prose(seed, 120).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(draw.randint(0, 6)):
            w[draw.randrange(len(w))] = f"new{draw.randint(0, 9999)}"
        out.append(" ".join(w))
    return out


def test_against_all_pairs(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)  # several blocks of a bucket
    texts = [t for s in range(4) for t in variants(prose, 40, s)] + [prose(s, 80) for s in range(100, 140)]
    texts += ["", "  \n", "one two", "ONE two", "one", texts[0].upper(), texts[5]]
    rows = [(3 * k + 1, t) for k, t in enumerate(texts)]
    for size, similarity in ((3, 0.85), (5, 0.8)):
        got = near_dup.near_duplicates(documents(rows), size, similarity).collect()
        want = brute(rows, size, similarity)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_nulls_repeats_and_empty_tables(documents, prose):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(5, a), (3, a), (None, a), (None, b), (None, b), (7, None), (8, ""), (9, b * 2000), (3, a)]
    got = sorted(map(tuple, near_dup.near_duplicates(documents(rows), 3, 0.85).collect()), key=str)
    short = [(i, c, k) for i, _, c, k in got]
    assert short.count((3, 3, True)) == 2 and (5, 3, False) in short and (None, 3, False) in short
    assert short.count((None, None, None)) == 2 and (7, 7, True) in short and (8, 8, True) in short
    assert near_dup.near_duplicates(documents([]), 3, 0.85).count() == 0
    kept = near_dup.deduplicated(documents(rows))
    assert kept.columns == documents([]).columns
    ids = sorted([r["doc_id"] for r in kept.collect()], key=str)
    assert ids == [3, 7, 8, 9, None, None, None]


def test_odd_sketches_estimate_high_similarity():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 2000, dtype=np.uint64)
    other = np.concatenate([values[:1900], draw.integers(0, 1 << 63, 100, dtype=np.uint64)])
    samples = near_dup.signatures(np.concatenate([values, other]), np.array([0, 2000, 4000]))
    flips = np.bitwise_count(np.bitwise_xor(*near_dup.odd_sketches(samples))).sum()
    bits = 64 * near_dup.SKETCH_WORDS
    differing = -bits / 2 * np.log(1 - 2 * flips / bits)
    assert abs(1 - differing / 2 / near_dup.SAMPLES - 1900 / 2100) < 0.08
    assert flips <= near_dup.most_flips(0.85)


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(1, k) for k in range(200, 260)]
    links = spark.createDataFrame([*path, *star, (None, 3), (4, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys([1, *range(200, 260)], 1)}


def test_components_of_long_shuffled_paths(spark):
    links, want = [], {}
    for path, low in ((list(range(2, 401)) + [1], 1), (random.Random(3).sample(range(1_000, 1_400), 400), 1_000)):
        links += zip(path, path[1:])
        want |= dict.fromkeys(path, low)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
