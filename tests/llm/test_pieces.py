"""Piece lattices against a k-best recursion, and exact decoding."""

from __future__ import annotations

from itertools import accumulate, product

import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forespell.llm import pieces, queries
from forespell.llm.words import buffer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table():
    return pieces.pieces(public_tokenizers.path(pieces.MODEL))


def brute(table, text, n):
    if not text:
        return [0.0]
    known = {table.bytes_of[i]: s for i, s in zip(table.ids.tolist(), table.scores.tolist(), strict=True)}
    data = b" " + text.encode()
    heads = [k for k in range(len(data) + 1) if k == len(data) or data[k] & 0xC0 != 0x80]
    best = {0: [0.0]}
    for a, b in zip(heads, heads[1:], strict=False):
        steps = [(c, known[data[a:c]]) for c in heads if a < c <= a + 64 and data[a:c] in known]
        if data[a:b] not in known:
            steps.append((b, table.byte_score * (b - a)))
        for c, score in steps:
            best[c] = sorted(best.get(c, []) + [x + score for x in best[a]], reverse=True)[:n]
    return best[len(data)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abthe é▁日\n\x00", max_size=14), min_size=1, max_size=5))
def test_nbest_and_decoding(table, texts):
    data, offsets = buffer(pa.array(texts))
    for text, (ids, best, ok) in zip(texts, pieces.encode_slice(table, data, offsets, 4), strict=True):
        assert ok and [s for s, _ in best] == pytest.approx(brute(table, text, 4))
        assert best[0][1].tolist() == ids.tolist()
        assert len({tuple(i.tolist()) for _, i in best}) == len(best)
        for _, other in best:
            assert bytes(table.decode(other))[1:].decode() == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=4), max_size=4), st.integers(1, 12))
def test_cheapest_choices(steps, n):
    lists = [[0.0, *map(float, accumulate(s))] for s in steps]
    every = sorted((sum(d[k] for d, k in zip(lists, pick, strict=True)), pick) for pick in product(*[range(len(d)) for d in lists]))
    assert pieces.best_of_text(lists, n) == every[:n]


def test_many_best(table):
    data, offsets = buffer(pa.array(["the river stone and the light of the house by the sea"]))
    ((_, best, ok),) = pieces.encode_slice(table, data, offsets, 40)
    assert ok and [s for s, _ in best] == pytest.approx(brute(table, data.tobytes().decode(), 40))


def test_round_trip_of_all_documents(spark):
    docs = queries.table(spark, SF_DIR, "documents")
    back = pieces.decode(pieces.encode(docs, n=2)).withColumnRenamed("text", "back").join(docs, "doc_id")
    assert back.count() == docs.count() and back.filter("back != text").isEmpty()
    assert queries.op10_pieces(spark, SF_DIR).filter("not decoded or size(nbest_scores) != 3").isEmpty()


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "x" * 300_000), (3, "x" * 300_000), (4, "  spaces   inside ")]
    got = pieces.digest(documents(rows)).collect()
    assert len(got) == len(rows) and all(r["decoded"] for r in got)
    assert [(r["n_pieces"], r["nbest_scores"]) for r in got if r["doc_id"] in (1, 2)] == [(0, [0.0])] * 2
    assert pieces.digest(documents([])).count() == 0 and pieces.encode(documents([])).count() == 0
