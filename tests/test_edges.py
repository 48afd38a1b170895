"""Edges of the tree of shared beginnings, and dictionaries that know their sources."""

from __future__ import annotations

import os

import pytest
from brute import fold, random_pairs

import forespell as fs


def brute_edges(pairs, key):
    keys = sorted(key(t) for t, _ in pairs)
    nodes = {"", *keys, *(os.path.commonprefix([a, b]) for a, b in zip(keys, keys[1:], strict=False))}
    forks = {"", *(os.path.commonprefix([a, b]) for a, b in zip(keys, keys[1:], strict=False))}
    out = []
    for node in nodes - {""}:
        parent = max((f for f in forks if node.startswith(f) and f != node), key=len)
        under = [w for t, w in pairs if key(t).startswith(node)]
        out.append((parent, node[len(parent):], len(under), max(under), node in keys))
    return sorted(out)


@pytest.mark.parametrize("case_sensitive", [True, False])
@pytest.mark.parametrize("partitions", [1, 13])
def test_edges(spark, entries, case_sensitive, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = [*random_pairs(5, 150, "abAé", 9, 7), ("long" * 30 + "a", 3), ("long" * 30 + "b", 4)]
        got = sorted(map(tuple, fs.prefix_edges(entries(pairs), case_sensitive).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_edges(pairs, (lambda t: t) if case_sensitive else fold)


def test_edges_of_small_dictionaries(spark, entries):
    assert fs.prefix_edges(entries([])).count() == 0
    assert [tuple(r) for r in fs.prefix_edges(entries([("abc", 2)])).collect()] == [("", "abc", 1, 2, True)]
    assert sorted(map(tuple, fs.prefix_edges(entries([("", 1), ("a", 2), ("ab", 5)])).collect())) == [("", "a", 2, 5, True), ("a", "b", 1, 5, True)]


def test_a_changed_source_is_noticed(spark, entries, tmp_path):
    path, source = str(tmp_path / "d"), tmp_path / "in"
    source.mkdir()
    (source / "1.tsv").write_text("a\t1\n")
    read = lambda: fs.read_weighted_strings(spark, str(source))
    built = []

    def build():
        built.append(1)
        return read()

    check = lambda: sorted(map(tuple, fs.load_or_build(spark, path, build, mode="check", sources=[str(source)]).collect()))
    assert check() == [("a", 1)] and check() == [("a", 1)] and len(built) == 1
    (source / "2.tsv").write_text("b\t2\n")
    assert check() == [("a", 1), ("b", 2)] and check() == [("a", 1), ("b", 2)] and len(built) == 2
    os.utime(source / "1.tsv", (1, 1))
    assert check() and len(built) == 3
    (source / "2.tsv").unlink()
    assert check() == [("a", 1)] and len(built) == 4
    assert fs.load_or_build(spark, path, build).count() == 1 and len(built) == 4
    with pytest.raises(ValueError):
        fs.load_or_build(spark, path, build, mode="check")
