"""Tables of position ranges against plain Python."""

from __future__ import annotations

import random

import pytest
from brute import random_pairs, scan_best
from test_plans import plan_of

import forespell as fs
from forespell.plans import blocks


def by_position(pairs):
    return sorted(pairs, key=lambda p: p[0].encode())


def made_ranges(seed, size, n=60):
    draw = random.Random(seed)
    rows = [(i, lb := draw.randint(-3, size + 3), lb + draw.choice([0, 1, 2, 5, 17, size, -4]), draw.choice([1, 2, 7, 40, None])) for i in range(n)]
    return [*rows, (n, 0, size, 3), (n + 1, 0, size, 3), (n + 2, None, 4, 1), (n + 3, 2, None, 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "rid LONG, lb LONG, rb LONG, k INT")


def got(df):
    out = {}
    for r in df.orderBy("rid", "rank").collect():
        out.setdefault(r.rid, []).append((r.pos, r.text, r.weight))
    return out


def expected(pairs, ranges, pick):
    entries, out = by_position(pairs), {}
    for rid, lb, rb, k in ranges:
        if lb is None or rb is None:
            continue
        inside = [(pos, *entries[pos]) for pos in range(max(lb, 0), min(rb, len(entries)))]
        if rows := pick(inside, 10 if k is None else k):
            out[rid] = rows
    return out


def last_wins(inside, k):
    return sorted(inside, key=lambda e: (e[2], e[0]), reverse=True)[:k]


def scan_wins(inside, k):
    place = {t: p for p, t, _ in inside}
    return [(place[t], t, w) for t, w in scan_best([(t, w) for _, t, w in inside], "", k)]


@pytest.mark.parametrize("fan", [4, 16])
@pytest.mark.parametrize("ties", ["last", "scan"])
def test_ranges(spark, entries, fan, ties):
    pairs = random_pairs(fan, 200, "abc", 5, 5)
    ranges = made_ranges(fan, len(pairs))
    maxima = fs.block_maxima(fs.with_position(entries(pairs)), fan)
    found = got(fs.heaviest_in_ranges(maxima, frame(spark, ranges), ties))
    assert found == expected(pairs, ranges, last_wins if ties == "last" else scan_wins)


def test_stored_blocks_and_large_tables_of_ranges(spark, entries, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "BROADCAST_ROWS", 1)
    pairs = random_pairs(9, 300, "abcd", 9, 5)
    ranges = made_ranges(5, len(pairs), 100)
    fs.save_block_maxima(fs.block_maxima(fs.with_position(entries(pairs)), 4), str(tmp_path / "b"))
    maxima = fs.load_block_maxima(spark, str(tmp_path / "b"))
    assert maxima.fan == 4 and len(maxima.levels) >= 3
    assert got(fs.heaviest_in_ranges(maxima, frame(spark, ranges))) == expected(pairs, ranges, last_wins)


def test_argmaxes(spark, entries):
    pairs = random_pairs(4, 100, "ab", 3, 7)
    order = by_position(pairs)
    maxima = fs.block_maxima(fs.with_position(entries(pairs)), 8)
    rows = [(i, lo, hi) for i, (lo, hi) in enumerate([(0, 0), (3, 20), (0, len(order) - 1), (5, 4), (len(order), len(order) + 3)])]
    found = {r.rid: r.pos for r in fs.range_argmaxes(maxima, spark.createDataFrame(rows, "rid LONG, first LONG, last LONG")).collect()}
    want = {i: max(range(lo, min(hi + 1, len(order))), key=lambda p: (order[p][1], p)) for i, lo, hi in rows if lo <= min(hi, len(order) - 1)}
    assert found == want


def test_a_wide_range_meets_few_blocks(spark, entries):
    """A range over everything needs its blocks on each level and k opened ones, not all entries."""
    ranges = spark.createDataFrame([("r", 1, 999_999, 3)], "range STRING, lb LONG, rb LONG, n INT")
    row = blocks._covering(ranges, 3, 100).first()
    assert [len(row[f"nodes_{i}"]) for i in range(4)] == [99 + 99, 99 + 99, 98, 0]
    covered = {p for i in range(4) for node in row[f"nodes_{i}"] for p in range(node * 100**i, (node + 1) * 100**i)}
    assert covered == set(range(1, 999_999))


def test_nothing_is_joined_by_comparison(spark, entries):
    maxima = fs.block_maxima(fs.with_position(entries(random_pairs(1, 50))), 4)
    plan = plan_of(fs.heaviest_in_ranges(maxima, frame(spark, [(1, 0, 40, 2)])))
    for forbidden in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python"):
        assert forbidden not in plan


def test_empty_tables(spark, entries):
    maxima = fs.block_maxima(fs.with_position(entries([])), 4)
    assert fs.heaviest_in_ranges(maxima, frame(spark, [(1, 0, 4, 2)])).count() == 0
    some = fs.block_maxima(fs.with_position(entries([("a", 1)])), 4)
    assert fs.heaviest_in_ranges(some, frame(spark, [])).count() == 0


@pytest.mark.parametrize("ties", ["last", "scan"])
def test_chunks_and_the_tree_above_them(spark, entries, monkeypatch, ties):
    """Ranges over many chunks, in families of a tree with several levels; hot chunks are spread."""
    monkeypatch.setattr(blocks, "CHUNK", 4)
    monkeypatch.setattr(blocks, "HOT_COPIES", 5)
    pairs = random_pairs(21, 300, "abcd", 6, 4)
    ranges = made_ranges(8, len(pairs), 150)
    ranges += [(1_000 + i, lb, lb + width, 3) for i, (lb, width) in enumerate((lb, w) for lb in range(0, len(pairs), 7) for w in (3, 4, 5, 9, 31, 64, 130, 10**12))]
    ranges += [(5_000, 0, len(pairs), 600), (5_001, 2, 5, 2**31 - 1)]
    maxima = fs.block_maxima(fs.with_position(entries(pairs)), 2)
    found = got(fs.heaviest_in_ranges(maxima, frame(spark, ranges), ties))
    assert found == expected(pairs, ranges, last_wins if ties == "last" else scan_wins)


@pytest.mark.parametrize("chunk", [4, 512])
def test_positions_with_gaps(spark, monkeypatch, chunk):
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    rows = [(f"t{p:03}", p * 7 % 11, p) for p in range(5, 90) if p % 3 and not 40 < p < 60]
    positioned = spark.createDataFrame([*rows, ("none", 50, None)], "text STRING, weight BIGINT, pos BIGINT")
    ranges = [(i, lb, lb + width, 2) for i, (lb, width) in enumerate((lb, w) for lb in range(0, 95, 5) for w in (1, 4, 18, 70))]
    want = {}
    for rid, lb, rb, k in ranges:
        inside = [(p, t, w) for t, w, p in rows if lb <= p < rb]
        if inside:
            want[rid] = last_wins(inside, k)
    assert got(fs.heaviest_in_ranges(fs.block_maxima(positioned, 4), frame(spark, ranges))) == want


@pytest.mark.parametrize("ties", ["last", "scan"])
def test_what_is_asked_moves_as_one_row(spark, entries, ties):
    """A narrow range meets its window in one row and is cut out of it before anything is copied or exploded."""
    maxima = fs.block_maxima(fs.with_position(entries(random_pairs(3, 100))), 64)
    plan = plan_of(fs.heaviest_in_ranges(maxima, frame(spark, [(i, i, i + 30, 2) for i in range(50)]), ties))
    assert "Window" not in plan
    joined = [line for line in plan.splitlines() if "Join" in line]
    assert len(joined) == 1
