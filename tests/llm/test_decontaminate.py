"""Benchmark passages against a search for exact copies, and paraphrases."""

from __future__ import annotations

import re

from forespell.llm import decontaminate, queries
from forespell.llm.decontaminate import common_subsequence

import numpy as np

SF_DIR = "/root/testdata/sf0.01"


def plain(text):
    return f" {' '.join(re.findall(r'[^\W_]+', text.lower()))} "


def test_finds_every_exact_passage_and_no_other(spark):
    docs = queries.table(spark, SF_DIR, "documents").collect()
    items = [(r["item_id"], plain(r["text"])) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    want = {(d["doc_id"], i) for d in docs for i, t in items if t in plain(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontamination(spark, SF_DIR).collect()}
    assert want and got == want


def test_paraphrases_answers_and_odd_rows(spark, documents, prose):
    items = [prose(s, 40) for s in range(30)]
    near = items[0].split()
    for k in range(3, 40, 6):
        near[k] = "changed"
    half = " ".join(items[1].split()[:15])
    rows = [(1, prose(90, 60) + " " + " ".join(near) + " " + prose(91, 60)), (2, prose(92, 300) + " " + half), (3, None), (4, ""), (None, items[2])]
    rows += [(5, items[3].upper().replace(" ", ", ")), (5, items[3]), (6, prose(93, 30_000) + " " + items[4]), (7, prose(94, 500))]
    benchmark = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (3, items[3])], "item_id long, text string")
    got = sorted([(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(rows), benchmark).collect()], key=str)
    assert got == [(1, 0), (5, 3), (5, 3), (5, 3), (5, 3), (6, 4), (None, 2)]
    clean = decontaminate.decontaminated(documents(rows), benchmark)
    assert clean.columns == documents([]).columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4, 7]
    assert decontaminate.leaks(documents(rows), benchmark.filter("false")).count() == 0
    assert decontaminate.leaks(documents([]), benchmark).count() == 0
    far = items[5].split()
    for k in range(0, 40, 3):
        far[k] = "changed"
    asked = spark.createDataFrame([(1, items[5], "elsewhere"), (2, items[6], items[6].split()[1])], "item_id long, text string, answer string")
    assert decontaminate.leaks(documents([(1, " ".join(far))]), asked).count() == 0


def test_items_in_blocks(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 7)
    items = [prose(s, 30) for s in range(20)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.leaks(documents([(k, f"{prose(60 + k, 40)} {t}") for k, t in enumerate(items)]), benchmark)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(k, k) for k in range(20)]


def test_longest_common_subsequence():
    draw = np.random.default_rng(0)
    for _ in range(50):
        a, b = draw.integers(0, 6, 30).astype(np.uint64), draw.integers(0, 6, 50).astype(np.uint64)
        table = np.zeros((31, 51), int)
        for i in range(30):
            for j in range(50):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert common_subsequence(a, b) == table[-1, -1]


def long_items(n, length, seed=5, swapped=0.3):
    """Items of Zipf words, and copies of them with a share of the words swapped for others; the first word is the answer."""
    draw = np.random.default_rng(seed)
    share = 1 / np.arange(1, 8_001) ** 0.9
    made = lambda size: draw.choice(8_000, size, p=share / share.sum())
    items = made((n, length))
    other = np.where(draw.random(items.shape) < swapped, made(items.shape), items)
    other[:, 0] = items[:, 0]
    text = lambda row: " ".join(f"w{k}" for k in row)
    return [text(i) for i in items], [text(i) for i in other], [text(made(300)) for _ in range(2 * n)]


def paraphrased_leaks(spark, documents, n, every):
    """Leaks found, and those planted, for items of three pieces each."""
    items, near, other = long_items(n, 140)
    rows = [(k, f"{other[2 * k]} {near[k]} {other[2 * k + 1]}") for k in range(0, n, every)]
    rows += [(1_000_000 + k, text) for k, text in enumerate(other)]
    benchmark = spark.createDataFrame([(k, t, t.split()[0]) for k, t in enumerate(items)], "item_id long, text string, answer string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(rows), benchmark).collect()}
    return got, {(k, k) for k in range(0, n, every)}


def test_long_paraphrased_items_with_more_pieces_than_a_space_has_directions(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "RANK", 128)
    got, want = paraphrased_leaks(spark, documents, 120, 2)
    assert got == want


def test_blocks_are_bounded_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "RANK", 36)
    made = [(k, " ".join(["word"] * (48 * (1 + k % 3)))) for k in range(20)] + [(100, "word " * 48 * 9), (101, None), (102, ".")]
    blocks = [decontaminate.read_items(b) for b in decontaminate.item_blocks(spark.createDataFrame(made, "item_id long, text string"))]
    assert sorted(i for b in blocks for i in b.ids) == [*range(20), 100]
    for b in blocks:
        assert sum(len(decontaminate.cut(w)) for w in b.words) <= 4 or b.ids == [100]


def test_the_space_is_fitted_on_every_passage(spark, documents, prose):
    """The pair sums are those of all passages; no share of them, however many there are."""
    items = [prose(s, 40) for s in range(12)]
    # more passages in a slice than a bounded pick of them would keep
    rows = [(k, prose(100 + k, 32)) for k in range(700)]
    asked = decontaminate.read_items(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    vocabulary = decontaminate.Vocabulary(np.unique(np.concatenate(asked.words)))
    counts, passages, lists = decontaminate.passage_counts(documents(rows), vocabulary)
    assert passages == 700
    idf = decontaminate.weights(asked.words, vocabulary, counts, passages)
    made = decontaminate.pair_sums(lists.selectExpr("*", "2L as copies"), idf).collect()
    matrix = np.zeros((len(idf), len(idf)))
    for r in made:
        matrix[r["term"], r["others"]] = np.array(r["sums"]) / decontaminate.UNIT
    data, offsets = decontaminate.buffer(decontaminate.pa.array([t for _, t in rows]))
    found = decontaminate.words(data, offsets, fold=True, bare=True)
    full = np.zeros((700, len(idf)))
    at, term = vocabulary.find(found.hash)
    full[found.doc[at], term] = idf[term]
    full /= np.maximum(np.linalg.norm(full, axis=1, keepdims=True), 1e-9)
    assert np.allclose(matrix, 2 * full.T @ full, atol=1e-5)
    space = decontaminate.latent_space(decontaminate.pair_sums(lists.selectExpr("*", "1L as copies"), idf), len(idf), 8)
    best = np.linalg.svd(full, full_matrices=False)[1][:8]
    assert np.linalg.norm(full @ space) > 0.9 * np.linalg.norm(best)
