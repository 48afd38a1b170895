from __future__ import annotations

import pytest
from brute import fold, random_pairs

import forespell as fs
from forespell.operators import prepare

REPEATED = [("x", 5), ("x", 2), ("x", 9), ("Ab", 5), ("aB", 1), ("AB", 7), ("é", 1), ("É", 2)]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("how, kept", [("min", 2), ("max", 9), ("sum", 16)])
def test_duplicates(entries, how, kept):
    found = dict(rows(fs.dedup(entries(REPEATED), on_duplicate=how)))
    assert found["x"] == kept and len(found) == 6


@pytest.mark.parametrize("how, ab", [("min", ("AB", 7)), ("max", ("AB", 7)), ("sum", ("AB", 13))])
def test_duplicates_that_fold_alike(entries, how, ab):
    found = fs.dedup(entries(REPEATED), case_sensitive=False, on_duplicate=how).collect()
    by_key = {r.folded: (r.text, r.weight) for r in found}
    assert by_key["ab"] == ab
    # only A-Z fold
    assert set(by_key) == {"x", "ab", "é", "É"}


def test_heaviest_spelling_with_ties(entries):
    pairs = [("b", 3), ("B", 3), ("a", 1), ("A", 2)]
    found = fs.dedup(entries(pairs), case_sensitive=False, on_duplicate="max").collect()
    assert {(r.text, r.weight) for r in found} == {("B", 3), ("A", 2)}


def test_unknown_duplicate_rule(entries):
    with pytest.raises(ValueError):
        fs.dedup(entries(REPEATED), on_duplicate="first")


@pytest.mark.parametrize("unique", [True, False])
def test_order_is_by_bytes_then_weight(entries, unique):
    pairs = [("b", 1), ("a", 9), ("a", 2), ("é", 1), ("Z", 1), ("z", 1), ("", 4)]
    assert rows(fs.sort_dictionary(entries(pairs), unique=unique)) == sorted(
        pairs, key=lambda p: (p[0].encode(), p[1])
    )


def test_order_without_case(entries):
    pairs = [("b", 1), ("A", 9), ("a", 2), ("B", 1), ("_", 3), ("É", 1)]
    expected = sorted(pairs, key=lambda p: (fold(p[0]).encode(), p[0].encode(), p[1]))
    assert rows(fs.sort_dictionary(entries(pairs), case_sensitive=False)) == expected


def test_equal_rows_are_split_into_chunks(entries, monkeypatch):
    monkeypatch.setattr(prepare, "COPIES_PER_CHUNK", 3)
    pairs = [("hot", 1)] * 10 + [("a", 1), ("z", 2)]
    chunks = prepare.spread_copies(entries(pairs)).groupBy("text", "_chunk").count().collect()
    assert sorted((r["text"], r["_chunk"], r["count"]) for r in chunks) == [
        ("a", 0, 1), ("hot", 0, 3), ("hot", 1, 3), ("hot", 2, 3), ("hot", 3, 1), ("z", 0, 1),
    ]
    assert rows(fs.sort_dictionary(entries(pairs))) == sorted(pairs)
    placed = fs.with_position(entries(pairs), unique=False).orderBy("pos")
    assert rows(placed) == [(*pair, i) for i, pair in enumerate(sorted(pairs))]


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_positions(entries, case_sensitive):
    pairs = random_pairs(3, 200, "abAB", 9, 6)
    key = (lambda t: t) if case_sensitive else fold
    expected = sorted(pairs, key=lambda p: (key(p[0]), p[0]))
    placed = fs.with_position(entries(pairs).repartition(5), case_sensitive).orderBy("pos")
    assert rows(placed) == [(*pair, i) for i, pair in enumerate(expected)]


def test_statistics(entries):
    assert rows(fs.input_stats(entries([("é", 4), ("ab", 9)]))) == [(2, 4, 9)]
    assert rows(fs.input_stats(entries([]))) == [(0, 0, None)]
    assert rows(fs.row_counts(entries(REPEATED))) == [(8, 6)]
    assert rows(fs.row_counts(entries(REPEATED), case_sensitive=False)) == [(8, 4)]
    assert rows(fs.row_counts(entries([]))) == [(0, 0)]


def test_heaviest_position_in_a_range(entries):
    placed = fs.with_position(entries([("a", 1), ("b", 5), ("c", 5), ("d", 9)]))
    assert rows(fs.range_argmax(placed, 0, 2)) == [("c", 5, 2)]
    assert rows(fs.range_argmax(placed, 0, 3)) == [("d", 9, 3)]
    assert rows(fs.range_argmax(placed, 7, 9)) == []
