"""Substring dedup against sets of word tuples."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from forespell.llm import substring_dedup as sd


def brute(rows, size):
    """(doc_id, n_words, n_removed, kept) of each row."""
    worded = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    least: dict = {}
    for d, w in worded:
        if d is not None:
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in worded:
        gone = set()
        for i in range(len(w) - size + 1) if d is not None else ():
            if least[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_of(seed, n):
    """Texts with shared passages, near copies, exact copies, odd spaces and null texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["Élan", "日本", "x" * 3000]
    passage = lambda k: [draw.choice(vocabulary) for _ in range(k)]
    shared = [passage(draw.randint(5, 60)) for _ in range(6)]
    rows = []
    for d in range(n):
        words = passage(draw.randint(0, 80))
        for _ in range(draw.randint(0, 3)):
            part = draw.choice(shared)
            low = draw.randint(0, len(part) // 2)
            at = draw.randint(0, len(words))
            words[at:at] = part[low : draw.randint(low, len(part))]
        rows.append((d * 7 % n, "".join(w + draw.choice([" ", " ", "\n", " \t", "  "]) for w in words)))
    hot = " ".join(passage(40))
    rows += [(n + k, f"{hot} tail{k}" if k % 3 else hot) for k in range(n)]
    rows += [(4 * n + k, f"start{k} " + "to and fro " * 30 + "to " + " ".join(passage(4))) for k in range(12)]
    return [*rows, (None, hot), (None, None), (5, None), (6, ""), (3, hot), (3, hot), (3, f"{hot} more"), (-4, "one two"), (9 * n, "one two"), (n * 9, " ".join(["again"] * 40)), (n * 10, " ".join(["again"] * 30))]


def frame(spark, rows):
    rows = [(d, t, 1, "x", [2], "y", 3) for d, t in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, at int, name string, copies array<int>, variant string, doc int")


@pytest.mark.parametrize(("seed", "size"), [(1, 13), (2, 13), (3, 5), (4, 3), (5, 30)])
def test_against_sets(spark, seed, size):
    rows = rows_of(seed, 40)
    got = result(sd.deduplicated(frame(spark, rows).repartition(6), size))
    assert got == brute(rows, size)


def test_digest_and_empty_tables(spark):
    rows = [(1, " a  b "), (2, None)]
    got = result(sd.digest(sd.deduplicated(frame(spark, rows))))
    assert got == [(1, 2, 0, hashlib.sha256(b"a b").hexdigest()), (2, 0, 0, hashlib.sha256(b"").hexdigest())]
    assert sd.deduplicated(frame(spark, rows).filter("false")).count() == 0


def test_planted_passage_survives_every_level(spark):
    """A passage of 13 words in otherwise different texts, in every place, one word off, and across many texts."""
    draw = random.Random(8)
    passage = [f"p{k}" for k in range(13)]
    rows = []
    for d in range(60):
        words = [f"d{d}x{draw.randint(0, 9)}" for _ in range(30)]
        words[d % 31 : d % 31] = passage if d % 2 else passage[:12]
        rows.append((d, " ".join(words)))
    got = {r[0]: r[2] for r in result(sd.deduplicated(frame(spark, rows)))}
    assert got == {d: 13 if d % 2 and d > 1 else 0 for d in range(60)}


def test_common_windows_are_one_row_a_text_and_settled_by_document(spark):
    """A window in all texts, many times in each: one row a text, dealt by document but for the least of the slice."""
    rows = [(k, f"head{k} " + "round and " * 40) for k in range(90)]
    docs = frame(spark, rows).repartition(3).selectExpr("doc_id AS doc", "text", "hash(text) AS variant", "cast(null AS array<int>) AS copies", "array(0L) AS repeated")
    sent = docs.mapInArrow(sd._send(0, 4), sd._WINDOW).toPandas()
    common = sent.groupby("hash").filter(lambda g: len(g) > 1)
    assert common.groupby(["hash", "doc"]).size().max() == 1 and (common["at"] < 0).all()
    assert (common["kind"] != sd.SETTLED).sum() <= 2 * 3 and (common["kind"] == sd.SETTLED).sum() >= 2 * 87


def test_lengths_windows_and_samples():
    assert sd.lengths(13) == [4, 7, 13] and sd.lengths(3) == [3] and sd.lengths(50) == [4, 7, 13, 25, 50]
    values = np.random.default_rng(1).integers(0, 30, 200).astype(np.uint64)
    for run in (1, 2, 5, 10):
        at = sd.least_of_runs(values, run)
        want = [max(range(i, i + run), key=lambda k: (-int(values[k]), k)) for i in range(len(values) - run + 1)]
        assert at.tolist() == want
    for size in (1, 2, 4, 7, 13):
        got = sd.grown(values, size)
        names: dict = {}
        for i, h in enumerate(got.tolist()):
            assert names.setdefault(h, tuple(values[i : i + size])) == tuple(values[i : i + size])
        assert len(got) == len(values) - size + 1
