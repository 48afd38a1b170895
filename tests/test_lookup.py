"""One prefix at a time."""

from __future__ import annotations

import pytest
from brute import best, matches, random_pairs, random_prefixes, scan_best
from cities import BEST_FIVE, CITIES

import forespell as fs


def pairs_of(df):
    return [(r.text, r.weight) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("prefix, case_sensitive, names", BEST_FIVE)
def test_cities(entries, prefix, case_sensitive, names):
    found = fs.complete(entries(CITIES), prefix, 5, case_sensitive)
    assert [text for text, _ in pairs_of(found)] == names


def test_city_ranges_and_counts(entries):
    cities = entries(CITIES)
    assert fs.prefix_range(cities, "").collect() == [(0, len(CITIES))]
    assert fs.prefix_range(cities, "C").collect() == [(15, 39)]
    assert fs.prefix_range(cities, "Cz").collect() == [(39, 39)]
    assert fs.prefix_range(cities, "c", case_sensitive=False).collect() == [(15, 39)]
    assert fs.match_count(cities, "Ca").collect() == [(12,)]
    assert fs.match_count(cities, "Rovem").collect() == [(0,)]


EDGES = [
    (["ab", "abc", "b"], "aba", []),
    (["ba", "baa"], "baa", ["baa"]),
    (["acc", "baa", "c", "cb", "cbb"], "cbb", ["cbb"]),
    (["aba", "abb", "abc"], "a", ["aba", "abb", "abc"]),
    (["solo"], "s", ["solo"]),
    (["ab", "cd"], "abc", []),
    (["", "a"], "", ["", "a"]),
    (["", "a"], "a", ["a"]),
    ([], "a", []),
]


@pytest.mark.parametrize("texts, prefix, expected", EDGES)
def test_prefix_edges(entries, texts, prefix, expected):
    found = fs.prefix_filter(entries([(t, 1) for t in texts]), prefix)
    assert sorted(r.text for r in found.collect()) == expected


def test_only_ascii_letters_fold(entries):
    dictionary = fs.with_folded(entries([("ÉX", 1), ("Abc", 2)]))
    assert fs.prefix_filter(dictionary, "éx", case_sensitive=False).collect() == []
    assert [r.text for r in fs.prefix_filter(dictionary, "Éx", case_sensitive=False).collect()] == ["ÉX"]
    assert [r.text for r in fs.prefix_filter(dictionary, "aB", case_sensitive=False).collect()] == ["Abc"]


def at(weights):
    return [(f"t{i:02}", w) for i, w in enumerate(weights)]


TIES = [
    ([4, 4, 3, 4, 4, 2, 4, 2, 4], 1, "last", [8]),
    ([4, 4, 3, 4, 4, 2, 4, 2, 4], 1, "scan", [0]),
    ([1, 2, 4, 1, 4, 3, 3], 2, "last", [4, 2]),
    ([1, 2, 4, 1, 4, 3, 3], 2, "scan", [4, 2]),
    ([2, 2, 2, 3], 2, "scan", [3, 1]),
]


@pytest.mark.parametrize("weights, k, ties, expected", TIES)
def test_ties(entries, weights, k, ties, expected):
    placed = fs.with_position(entries(at(weights)))
    by_range = fs.heaviest_in_range(placed, 0, len(weights), k, ties).orderBy("rank").collect()
    assert [r.pos for r in by_range] == expected
    by_prefix = fs.complete(placed, "t", k, ties=ties).orderBy("rank").collect()
    assert [r.text for r in by_prefix] == [f"t{i:02}" for i in expected]


@pytest.mark.parametrize("seed", range(4))
def test_random_single_lookups(entries, seed):
    pairs = random_pairs(seed)
    placed = fs.with_position(entries(pairs))
    for prefix in random_prefixes(seed, 3):
        for k in (1, 4):
            assert pairs_of(fs.complete(placed, prefix, k)) == best(pairs, prefix, k)
            assert pairs_of(fs.complete(placed, prefix, k, ties="scan")) == scan_best(pairs, prefix, k)


def test_range_window(entries):
    placed = fs.with_position(entries(at([5, 1, 7, 7, 2])))
    assert sorted(r.pos for r in fs.range_filter(placed, 1, 3).collect()) == [1, 2]
    found = fs.heaviest_in_range(placed, 1, 4, 2).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(1, 3, "t03", 7), (2, 2, "t02", 7)]


def test_refused_arguments(entries):
    with pytest.raises(ValueError):
        fs.complete(entries(CITIES), "a", 0)
    with pytest.raises(ValueError):
        fs.complete(entries(CITIES), "a", 1, ties="first")
    with pytest.raises(ValueError):
        fs.heaviest_in_range(fs.with_position(entries(CITIES)), 0, 1, -1)


WORDS = ["San Remo", "pulsan", "in_san", "x-SAN", "Élan san", "san", "né", "É (x)"]


@pytest.mark.parametrize(
    "query, expected",
    [
        ("san", ["San Remo", "x-SAN", "Élan san", "san"]),
        ("lan", ["Élan san"]),
        ("(x", []),
        (" s", ["Élan san"]),
        ("", WORDS),
        ("\\E", []),
    ],
)
def test_word_starts(entries, query, expected):
    found = fs.word_start_filter(entries([(w, 1) for w in WORDS]), query)
    assert sorted(r.text for r in found.collect()) == sorted(expected)


def test_word_starts_outside_ascii(spark, entries):
    texts = ["\u0130stanbul", "a \u212aelvin", "\u00c9cole \u00e9t\u00e9", "x (y)", "caf\u00e9 ole"]
    dictionary = entries([(t, 1) for t in texts])
    for query, expected in [("i", []), ("k", []), ("e", [texts[1]]), ("\u00e9", [texts[2], texts[4]]), ("COLE", [texts[2]]), ("(y", []), (" (y)", [texts[3]]), (".", [])]:
        one = sorted(r.text for r in fs.word_start_filter(dictionary, query).collect())
        queries = spark.createDataFrame([(1, query, 1)], "qid INT, q STRING, k INT")
        many = sorted(r.text for r in fs.word_start_matches(dictionary, queries).collect())
        assert one == many == sorted(expected), query


def test_navigation(entries):
    cities = entries(CITIES)
    facets = {r.next: (r.matches, r.max_weight) for r in fs.next_char_facets(cities, "Co").collect()}
    assert facets == {"s": (1, 1013), "v": (2, 41322)}
    ends = fs.next_char_facets(entries([("ab", 1), ("abc", 2)]), "ab").collect()
    assert {r.next: r.matches for r in ends} == {"": 1, "c": 1}
    assert fs.common_extension(cities, "Reg").collect() == [("Reglio ",)]
    assert fs.common_extension(cities, "rEG", case_sensitive=False).collect() == [("reglio ",)]
    assert fs.common_extension(cities, "Covo").collect() == [("Covo",)]
    assert fs.common_extension(cities, "x").collect() == [(None,)]
    assert fs.common_extension(cities, "").collect() == [("",)]


def test_long_common_extension(entries):
    stem = "é" * 5000
    found = fs.common_extension(entries([(stem + "a", 1), (stem + "b", 1)]), "é").collect()
    assert found == [(stem,)]


def test_match_agrees_with_brute_force_on_cities(entries):
    cities = entries(CITIES)
    for prefix in ("R", "s", "L’"):
        for case_sensitive in (True, False):
            found = fs.prefix_filter(cities, prefix, case_sensitive)
            assert sorted((r.text, r.weight) for r in found.collect()) == matches(CITIES, prefix, case_sensitive)
