"""Tables of prefixes, on both ways of meeting the dictionary."""

from __future__ import annotations

import json

import pytest
from brute import best, fold, matches, random_pairs, random_prefixes, scan_best
from cities import CITIES
from pyspark.sql import functions as F

import forespell as fs
from forespell.plans import prefixes as sizing
from forespell.plans.prefixes import distinct_prefixes, explode_prefixes, profile_queries, with_prefix


@pytest.fixture(params=["broadcast", "several", "shuffled"])
def either_way(request, monkeypatch):
    if request.param == "shuffled":
        request.getfixturevalue("shuffled")
    if request.param == "several":
        # the larger query tables then take two or three broadcasts
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 8)


def ask(spark, queries):
    return spark.createDataFrame([(i, q, k) for i, (q, k) in enumerate(queries)], "qid BIGINT, q STRING, k INT")


def by_query(df):
    found = {}
    for row in df.orderBy("qid", "rank").collect():
        found.setdefault(row.qid, []).append((row.text, row.weight))
    return found


@pytest.mark.parametrize("seed, case_sensitive", [(0, True), (1, False)])
def test_completions(spark, entries, either_way, seed, case_sensitive):
    pairs = random_pairs(seed, 150, "abAé", 5, 6)
    queries = [(q, 1 + i % 5) for i, q in enumerate(random_prefixes(seed, 12, "abAé"))]
    found = by_query(fs.complete_batch(entries(pairs), ask(spark, queries), case_sensitive))
    for qid, (q, k) in enumerate(queries):
        assert found.get(qid, []) == best(pairs, q, k, case_sensitive), q


@pytest.mark.parametrize("share", [0.02, 0.5])
def test_heavy_entries_first(spark, entries, either_way, share):
    pairs = random_pairs(4, 300, "ab", 9, 8)
    queries = [(q, 1 + i % 5) for i, q in enumerate(random_prefixes(4, 12, "ab"))]
    dictionary = entries(pairs)
    heavy_from = fs.heavy_weight(dictionary, share)
    assert 1 <= heavy_from <= 9
    answered = fs.complete_batch(dictionary, ask(spark, queries), heavy_from=heavy_from)
    found = by_query(answered)
    for qid, (q, k) in enumerate(queries):
        assert found.get(qid, []) == best(pairs, q, k), q
    assert fs.heavy_weight(entries([])) is None


@pytest.mark.parametrize("seed", [0])
def test_scan_ties(spark, entries, either_way, seed):
    pairs = random_pairs(seed, 150, "ab", 3, 7)
    queries = [(q, 1 + i % 6) for i, q in enumerate(random_prefixes(seed, 12, "ab", 4))]
    dictionary = fs.with_position(entries(pairs))
    answered = fs.complete_batch(dictionary, ask(spark, queries), ties="scan", keep_unmatched=True)
    found = by_query(answered)
    assert set(found) == set(range(len(queries)))
    for qid, (q, k) in enumerate(queries):
        assert found[qid] == (scan_best(pairs, q, k) or [(None, None)]), (q, k)


def test_unmatched_queries_can_be_kept(spark, entries, either_way):
    queries = ask(spark, [("Reglio", 1), ("Rovem", 5), ("Reglio", 9)])
    found = by_query(fs.complete_batch(entries(CITIES), queries, keep_unmatched=True))
    assert found == {
        0: [("Reglio Cavara", 69441)],
        1: [(None, None)],
        2: [("Reglio Cavara", 69441), ("Reglio Esina", 66283)],
    }
    assert set(by_query(fs.complete_batch(entries(CITIES), queries))) == {0, 2}


def test_counts_ranges_and_entries(spark, entries, either_way):
    pairs = random_pairs(11, 120, "abA", 9, 5)
    asked = random_prefixes(11, 12, "abA")
    queries = ask(spark, [(q, 1) for q in asked])
    dictionary = entries(pairs)
    for case_sensitive in (True, False):
        key = (lambda t: t) if case_sensitive else fold
        counts = dict(map(tuple, fs.match_counts(dictionary, queries, case_sensitive).collect()))
        ranges = {r.qid: (r.lb, r.rb) for r in fs.prefix_ranges(dictionary, queries, case_sensitive).collect()}
        found = sorted(map(tuple, fs.match_entries(dictionary, queries, case_sensitive).collect()))
        for qid, q in enumerate(asked):
            matching = matches(pairs, q, case_sensitive)
            below = sum(key(t) < key(q) for t, _ in pairs)
            assert counts[qid] == len(matching)
            assert ranges[qid] == (below, below + len(matching))
            assert [f[1:] for f in found if f[0] == qid] == sorted(matching)


def test_facets_and_extensions(spark, entries, either_way):
    queries = ask(spark, [("Co", 1), ("Reg", 1), ("nothing", 1)])
    facets = fs.next_char_facets_batch(entries(CITIES), queries).collect()
    assert {tuple(r) for r in facets} == {
        (0, "s", 1, 1013), (0, "v", 2, 41322), (1, "l", 2, 69441),
    }
    extensions = dict(map(tuple, fs.common_extensions(entries(CITIES), queries).collect()))
    assert extensions == {0: "Co", 1: "Reglio ", 2: None}


def test_a_missing_prefix_is_the_empty_one(spark, entries, either_way):
    queries = spark.createDataFrame([(0, None, 2), (1, "", 2)], "qid INT, q STRING, k INT")
    found = by_query(fs.complete_batch(entries(CITIES), queries))
    assert found[0] == found[1] == best(CITIES, "", 2)


def test_a_large_k_among_small_ones(spark, entries, either_way):
    rows = [(f"w{i:05d}", i * 7919 % 10_007) for i in range(3_000)]
    queries = spark.createDataFrame([(0, "w", 2_000), (1, "w0", 3), (2, "w00", 1)], "qid INT, q STRING, k INT")
    found = by_query(fs.complete_batch(entries(rows), queries))
    assert [found[i] for i in range(3)] == [best(rows, q, k) for q, k in (("w", 2_000), ("w0", 3), ("w00", 1))]


def test_words_within_entries(spark, entries, either_way):
    texts = ["San Remo", "pulsan", "x-SAN san", "in_san", "ÉLAN santo", "a\nsan", "né é", "--", "a-x", ""]
    asked = ["san", "r", "SAN R", "-x", "-", "élan", "", " s", "\nSAN"]
    dictionary = entries([(t, i) for i, t in enumerate(texts)])
    found = fs.word_start_matches(dictionary, ask(spark, [(q, 1) for q in asked])).collect()
    for qid, q in enumerate(asked):
        one = sorted(map(tuple, fs.word_start_filter(dictionary, q).collect()))
        assert sorted((r.text, r.weight) for r in found if r.qid == qid) == one, q
    by_query = {q: sorted(r.text for r in found if r.qid == i) for i, q in enumerate(asked)}
    assert by_query["san"] == ["San Remo", "a\nsan", "x-SAN san", "ÉLAN santo"]
    # the boundary before a letter outside A-Z is the end of an ASCII word
    assert by_query["élan"] == []
    assert by_query["-x"] == ["a-x"]


def test_no_queries_and_no_entries(spark, entries, either_way):
    nothing = ask(spark, [])
    assert fs.complete_batch(entries(CITIES), nothing).collect() == []
    assert fs.complete_batch(entries([]), ask(spark, [("a", 1)])).collect() == []
    assert fs.match_counts(entries([]), ask(spark, [("a", 1)])).collect() == [(0, 0)]


def test_lengths_are_generated_or_listed(spark, entries):
    keyed = entries([("abcdefghij", 1), ("abc", 2), ("", 3)]).withColumnRenamed("text", "key")
    for lengths in [(0, 1, 2, 3), (1, 3, 4), (0, 9), (2, 10, 50), (0,), ()]:
        got = explode_prefixes(keyed, "key", lengths).collect()
        expected = [k[:n] for k in ("abcdefghij", "abc", "") for n in lengths if n <= len(k)]
        assert sorted(r.prefix for r in got) == sorted(expected), lengths


def test_profile(spark):
    queries = ask(spark, [("a", 1), ("a", 7), ("é", 2), ("", 3), ("abc", 1)])
    profile = profile_queries(distinct_prefixes(with_prefix(queries, True)))
    assert profile == (4, 6, 87, 5, 2, 7, "", "é", (0, 1, 3))
    assert profile.broadcasts() == 1
    assert profile._replace(prefixes=sizing.BROADCAST_ROWS + 1).broadcasts() == 3
    assert profile._replace(prefix_bytes=2 * sizing.BROADCAST_BYTES).broadcasts() == 4
    assert profile._replace(prefixes=100 * sizing.BROADCAST_ROWS).broadcasts() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_prefix_shared_by_many_queries_is_salted(spark, entries, how):
    asked = ask(spark, [("C", 2)] * 50 + [("San", 2), ("Rovem", 2)] + [("none", 1)] * 20)
    asked = with_prefix(asked, True)
    distinct = distinct_prefixes(asked)
    profile = profile_queries(distinct)
    answers = entries([("C", 1), ("C", 2), ("San", 3)]).withColumnRenamed("text", "prefix")
    salted = sizing.hand_back(asked, answers, distinct, profile, how, hot_copies=8)
    plain = sizing.hand_back(asked, answers, distinct, profile, how, hot_copies=1000)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    # the hot prefix lands in several join groups
    spread = F.pmod(F.xxhash64(*asked.columns), F.lit(7))
    assert asked.filter("prefix = 'C'").select(spread).distinct().count() > 3


def test_large_k_is_merged_in_parts(spark, entries):
    pairs = random_pairs(5, 400, "abc", 50, 6)
    dictionary = entries(pairs).repartition(7)
    found = by_query(fs.complete_batch(dictionary, ask(spark, [("", 150), ("a", 120)])))
    assert found == {0: best(pairs, "", 150), 1: best(pairs, "a", 120)}


def test_shapes_of_the_answer(spark, entries):
    pairs = [('a"b\\c\x01\n/é', 5), ("ab", 3)]
    answered = fs.complete_batch(entries(pairs), ask(spark, [("a", 5), ("x", 5)]), keep_unmatched=True)
    documents = {r.qid: json.loads(r.json) for r in fs.suggestions_json(answered).collect()}
    assert documents == {
        0: {"suggestions": [{"value": pairs[0][0], "data": "0"}, {"value": "ab", "data": "1"}]},
        1: {"suggestions": []},
    }
    matched = answered.filter("rank IS NOT NULL")
    assert {tuple(r) for r in fs.suggestions_rows(matched).collect()} == {(0, pairs[0][0], "0"), (0, "ab", "1")}
    assert [r.line for r in fs.to_lines(matched).orderBy("rank").collect()] == [f"{t}  {w}" for t, w in pairs]


def test_documents_from_packed_completions(spark, entries):
    table = fs.build_completion_table(entries(CITIES), 2, 2)
    documents = {r.prefix: json.loads(r.json) for r in fs.suggestions_json(table).collect()}
    assert documents["Ca"] == {
        "suggestions": [{"value": "Cabanene", "data": "0"}, {"value": "Canesto", "data": "1"}]
    }
    unknown = spark.createDataFrame([(1, None)], "qid BIGINT, completions ARRAY<STRUCT<text: STRING, weight: BIGINT>>")
    assert fs.suggestions_json(unknown).collect() == [(1, None)]
