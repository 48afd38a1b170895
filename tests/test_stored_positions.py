"""Stored positions and stored word starts."""

from __future__ import annotations

import random

import pytest
from brute import fold, random_pairs, random_prefixes
from test_plans import plan_of

import forespell as fs
from forespell.plans import positions


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_positions_counts_and_extensions(spark, entries, tmp_path, case_sensitive):
    key = (lambda t: t) if case_sensitive else fold
    pairs = random_pairs(3, 300, "abAé", 9, 6)
    fs.save_positioned(entries(pairs), str(tmp_path / "d"), case_sensitive, files=9)
    stored = fs.load_positioned(spark, str(tmp_path / "d"))
    assert stored.manifest.count() > 3
    order = sorted(pairs, key=lambda p: (key(p[0]).encode(), p[0].encode(), p[1]))
    assert sorted((r.pos, r.text, r.weight) for r in stored.entries().collect()) == [(i, *p) for i, p in enumerate(order)]
    keys = [key(t).encode() for t, _ in order]
    for prefix in ["", "zz", "é", *random_prefixes(3, 6, "abA", 4)]:
        wanted = key(prefix).encode()
        lb, inside = sum(k < wanted for k in keys), [k for k in keys if k.startswith(wanted)]
        assert tuple(fs.stored_prefix_range(stored, prefix).first()) == (lb, lb + len(inside))
        assert fs.stored_match_count(stored, prefix).first().matches == len(inside)
        plain = fs.common_extension(entries(pairs), prefix, case_sensitive).first().extension
        assert fs.stored_common_extension(stored, prefix).first().extension == plain


def test_a_prefix_reads_two_files_at_most(spark, entries, tmp_path):
    pairs = [(f"w{i:05d}", i) for i in range(20_000)]
    fs.save_positioned(entries(pairs), str(tmp_path / "d"), files=100)
    stored = fs.load_positioned(spark, str(tmp_path / "d"))
    assert stored.manifest.count() >= 90
    for prefix in ("", "w", "w0", "w01", "w0123", "x", "a", "w19999", "w05"):
        parts = positions._ends(stored, prefix).parts
        assert len(parts.inputFiles()) <= 2
        found = tuple(fs.stored_prefix_range(stored, prefix).first())
        assert found == (sum(t < prefix for t, _ in pairs), sum(t < prefix or t.startswith(prefix) for t, _ in pairs))
    plan = plan_of(stored.entries())
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Window" not in plan


def test_equal_rows_and_empty_dictionaries(spark, entries, tmp_path):
    pairs = [("a", 1)] * 5 + [("b", 2)] * 3 + [("a", 0)]
    fs.save_positioned(entries(pairs), str(tmp_path / "d"), files=4)
    stored = fs.load_positioned(spark, str(tmp_path / "d"))
    assert sorted((r.pos, r.text, r.weight) for r in stored.entries().collect()) == [(i, *p) for i, p in enumerate(sorted(pairs))]
    fs.save_positioned(entries([]), str(tmp_path / "e"))
    empty = fs.load_positioned(spark, str(tmp_path / "e"))
    assert tuple(fs.stored_prefix_range(empty, "a").first()) == (0, 0)
    assert fs.stored_common_extension(empty, "").first().extension is None


def test_stored_word_starts(spark, entries, tmp_path, monkeypatch):
    draw = random.Random(4)
    words = ["the", "The", "then", "a-b", "x_y", "été", "Ou", "ou", "K"]
    pairs = sorted({(" ".join(draw.choices(words, k=draw.randint(0, 6))), draw.randint(1, 5)) for _ in range(120)})
    queries = fs.queries_from(spark, ["the", "TH", "ou", "b", "y", "", "the then", "été", "x_y the", "zzz", "the"])
    want = sorted(map(tuple, fs.word_start_matches(entries(pairs), queries).collect()))
    fs.save_word_starts(entries(pairs), str(tmp_path / "w"), reach=3)
    stored = fs.load_word_starts(spark, str(tmp_path / "w"))
    assert stored.postings.columns == ["key", "entry"] and len(want) > 50
    found = fs.stored_word_start_matches(stored, queries)
    assert sorted(map(tuple, found.collect())) == want
    plan = plan_of(found)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "postings" in line]
    assert scans and all("text" not in line.split("[")[1].split("]")[0] for line in scans)
    from forespell.plans import prefixes

    monkeypatch.setattr(prefixes, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, fs.stored_word_start_matches(stored, queries).collect())) == want
