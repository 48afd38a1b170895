"""More completions than Spark pushes a limit for: groups are cut by counts, exactly."""

from __future__ import annotations

import random

import pytest
from brute import best, random_pairs, scan_best
from pyspark.sql import functions as F
from test_plans import plan_of

import forespell as fs
from forespell.operators import batch
from forespell.plans import completion_table, prefixes, topn


@pytest.fixture
def no_limit_pushed(monkeypatch):
    for module in (batch, topn, completion_table):
        monkeypatch.setattr(module, "LIMIT_PUSHED", 2)


def asked(spark, pairs):
    return spark.createDataFrame([(i, q, k) for i, (q, k) in enumerate(pairs)], "qid LONG, q STRING, k INT")


def answers(df):
    found = {}
    for r in df.orderBy("qid", "rank").collect():
        found.setdefault(r.qid, []).append((r.text, r.weight))
    return found


QUERIES = [("", 40), ("a", 3), ("ab", 7), ("b", 100), ("c", 1), ("zz", 5), ("a", 9), ("abc", 2)]


@pytest.mark.parametrize("case_sensitive", [True, False])
@pytest.mark.parametrize("top_weight", [1, 6, 2_000, 10**17])
def test_cut_by_counts(spark, entries, no_limit_pushed, case_sensitive, top_weight):
    pairs = random_pairs(top_weight % 97, 300, "abcA", top_weight, 6)
    got = answers(fs.complete_batch(entries(pairs), asked(spark, QUERIES), case_sensitive))
    want = {i: best(pairs, q, k, case_sensitive) for i, (q, k) in enumerate(QUERIES)}
    assert got == {i: rows for i, rows in want.items() if rows}


@pytest.mark.parametrize("top_weight", [1, 4, 500])
def test_scan_ties_cut_by_counts(spark, entries, no_limit_pushed, top_weight):
    pairs = random_pairs(top_weight, 300, "abc", top_weight, 6)
    dictionary = fs.with_position(entries(pairs))
    got = answers(fs.complete_batch(dictionary, asked(spark, QUERIES), ties="scan"))
    want = {i: scan_best(pairs, q, k) for i, (q, k) in enumerate(QUERIES)}
    assert got == {i: rows for i, rows in want.items() if rows}


def test_cut_by_counts_in_a_shuffle(spark, entries, no_limit_pushed, shuffled):
    pairs = random_pairs(5, 300, "abc", 30, 6)
    got = answers(fs.complete_batch(entries(pairs), asked(spark, QUERIES)))
    assert got == {i: rows for i, (q, k) in enumerate(QUERIES) if (rows := best(pairs, q, k))}


@pytest.mark.parametrize("method", ["explode", "rollup"])
def test_completion_table_cut_by_counts(entries, no_limit_pushed, method):
    pairs = random_pairs(6, 300, "abc", 5, 6)
    for row in fs.build_completion_table(entries(pairs), 3, 7, method=method).collect():
        assert [tuple(e) for e in row.completions] == best(pairs, row.prefix, 7)


def test_rows_are_cut_before_the_exchange(spark, entries):
    """At k = 1,500 what leaves an input partition is bounded by counts, also among equal weights."""
    rng = random.Random(1)
    for weights in (lambda: rng.randint(0, 10**6), lambda: 1):
        pairs = [(f"{chr(97 + i % 26)}{i:06d}", weights()) for i in range(60_000)]
        rows = entries(pairs).withColumn("prefix", F.lit("")).withColumnRenamed("text", "key")
        following = F.substring("key", F.length("prefix") + 1, F.lit(1))
        kept = topn.within_reach(rows, "prefix", following, F.lit(1_500))
        assert 1_500 <= kept.count() <= 10_000
    df = fs.complete_batch(entries(pairs), asked(spark, [("", 1_500), ("a", 2)]))
    plan = plan_of(df)
    window = plan[plan.index("Window [row_number()") :]
    exchange = window.index("Exchange hashpartitioning(prefix")
    assert "Filter" in window[exchange:] and "_bucket" in window[exchange : exchange + 1_500]
    got = answers(df)
    assert got[0] == best(pairs, "", 1_500) and got[1] == best(pairs, "a", 2)


def test_one_large_k_does_not_weigh_on_the_others(spark, entries, monkeypatch):
    monkeypatch.setattr(prefixes, "SPARE_ROWS", 50)
    pairs = random_pairs(7, 400, "abcd", 9, 5)
    queries = [(q, 2) for q in ("a", "b", "ab", "cd", "", "dd")] + [("c", 60), ("", 1_200)]
    distinct = prefixes.distinct_prefixes(prefixes.with_prefix(asked(spark, queries), True))
    parts = prefixes.by_size_of_k(distinct, prefixes.profile_queries(distinct), topn.LIMIT_PUSHED)
    assert [(p.max_k, p.prefixes) for _, p in parts] == [(2, 5), (60, 1), (1_200, 1)]
    got = answers(fs.complete_batch(entries(pairs), asked(spark, queries)))
    assert got == {i: rows for i, (q, k) in enumerate(queries) if (rows := best(pairs, q, k))}


def test_a_query_without_k_gets_the_default(spark, entries):
    pairs = random_pairs(3, 200, "ab", 9, 8)
    got = answers(fs.complete_batch(entries(pairs), asked(spark, [("a", None), ("zz", None)]), keep_unmatched=True))
    assert got == {0: best(pairs, "a", prefixes.DEFAULT_K), 1: [(None, None)]}
