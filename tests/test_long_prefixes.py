"""Long prefixes meet entries by anchors; many prefixes sift the dictionary by a bitmap."""

from __future__ import annotations

import random

import pytest
from brute import best, matches
from pyspark.sql import functions as F
from test_large_k import answers, asked
from test_plans import plan_of

import forespell as fs
from forespell.plans import prefixes


def long_pairs(seed, n=60):
    """Texts of 0 to 900 characters that share beginnings of many lengths."""
    draw = random.Random(seed)
    stems = ["".join(draw.choices("ab", k=draw.randint(0, 300))) for _ in range(5)]
    texts = {draw.choice(stems)[: draw.randint(0, 300)] + "".join(draw.choices("abé", k=draw.randint(0, 600))) for _ in range(n)}
    return [(t, draw.randint(1, 9)) for t in sorted(texts)]


def cuts(pairs, seed, n=80):
    draw = random.Random(seed)
    out = [(t[: draw.randint(0, len(t))] + draw.choice(["", "", "a"]), draw.randint(1, 4)) for t, _ in draw.choices(pairs, k=n)]
    return [*out, ("", 3), *[(t[:n], 2) for t, _ in pairs[:3] for n in (15, 16, 17, 63, 64, 65, 256)]]


@pytest.mark.parametrize("case_sensitive", [True, False])
@pytest.mark.parametrize("many", [False, True])
def test_long_prefixes(spark, entries, monkeypatch, case_sensitive, many):
    if many:
        monkeypatch.setattr(prefixes, "BROADCAST_ROWS", -1)
    pairs = long_pairs(1)
    queries = cuts(pairs, 2)
    got = answers(fs.complete_batch(entries(pairs), asked(spark, queries), case_sensitive))
    assert got == {i: rows for i, (q, k) in enumerate(queries) if (rows := best(pairs, q, k, case_sensitive))}
    counts = dict(map(tuple, fs.match_counts(entries(pairs), asked(spark, queries), case_sensitive).collect()))
    assert counts == {i: len(matches(pairs, q, case_sensitive)) for i, (q, _) in enumerate(queries)}
    pairs_of = fs.match_entries(entries(pairs), asked(spark, queries), case_sensitive).collect()
    assert sorted((r.qid, r.text) for r in pairs_of) == sorted((i, t) for i, (q, _) in enumerate(queries) for t, _ in matches(pairs, q, case_sensitive))


def test_ranges_of_long_prefixes(spark, entries):
    pairs = long_pairs(3)
    queries = cuts(pairs, 4, 30)
    keys = sorted(t.encode() for t, _ in pairs)
    got = {r.qid: (r.lb, r.rb) for r in fs.prefix_ranges(entries(pairs), asked(spark, queries)).collect()}
    for i, (q, _) in enumerate(queries):
        lb = sum(k < q.encode() for k in keys)
        assert got[i] == (lb, lb + sum(k.startswith(q.encode()) for k in keys))


def test_rows_of_a_key_follow_the_anchors(spark, entries):
    """2,000 lengths are asked; a text that shares no long anchor has a row for each anchor length, and no other."""
    text = "".join(random.Random(5).choices("abcdefgh", k=2_000))
    distinct = asked(spark, [(text[:n], 1) for n in range(17, 2_001)]).select(F.col("q").alias("prefix"), "k", F.lit(1).alias("copies"))
    lengths = tuple(range(17, 2_001))
    assert prefixes.anchor_lengths(lengths) == [16, 64, 256, 1024]
    keyed = entries([("z" * 2_000, 1), (text[:20] + "z" * 1_980, 1), (text, 1)]).withColumnRenamed("text", "key")
    rows = prefixes.explode_long_prefixes(keyed, "key", distinct, lengths, True).groupBy("key").count().collect()
    assert {r.key[:30][-1] + r.key[:1]: r["count"] for r in rows} == {f"z{text[0]}": 63 - 16, f"{text[29]}{text[0]}": 2_000 - 16}
    assert "Generate explode(filter(" in plan_of(prefixes.explode_long_prefixes(keyed, "key", distinct, lengths, True))


def test_a_bitmap_sifts_before_the_exchange(spark, entries, shuffled):
    draw = random.Random(6)
    pairs = [("".join(draw.choices("abcdefghij", k=8)), 1) for _ in range(20_000)]
    queries = asked(spark, [(t[:6], 1) for t, _ in pairs[:200]])
    distinct = prefixes.distinct_prefixes(prefixes.with_prefix(queries, True))
    profile = prefixes.profile_queries(distinct)
    exploded = prefixes.explode_prefixes(entries(pairs).withColumnRenamed("text", "key"), "key", (6,))
    kept = prefixes.probably_asked(exploded, distinct, profile)
    wanted = {q[:6] for q, _ in pairs[:200]}
    assert kept.filter(F.col("prefix").isin(*wanted)).count() == sum(t[:6] in wanted for t, _ in pairs)
    assert kept.count() < 0.2 * len(pairs)  # all of them were shuffled before
    plan = plan_of(fs.complete_batch(entries(pairs), queries))
    window = plan[plan.index("Window [row_number()") :]
    exchange = window.index("Exchange hashpartitioning(prefix")
    assert "_bits" in window[exchange:] and "BroadcastHashJoin [_word" in window[exchange:]
