"""Word hashes of Arrow slices against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from forespell.llm.words import LONG, buffer, distinct, shingles, slices, span_hashes, words


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n　日", max_size=30)), max_size=8))
def test_words_and_shingles(texts):
    data, offsets = buffer(pa.array(texts, pa.string()))
    found = words(data, offsets, fold=True)
    want = [re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    assert np.diff(found.first).tolist() == [len(w) for w in want]
    names: dict = {}
    for h, w in zip(found.hash.tolist(), [x for w in want for x in w], strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    values, first = distinct(*shingles(found, 3), len(texts))
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set() for w in want]
    assert np.diff(first).tolist() == [len(s) for s in sets]
    for a in range(len(texts)):
        for b in range(a):
            common = len(set(values[first[a] : first[a + 1]].tolist()) & set(values[first[b] : first[b + 1]].tolist()))
            assert common == len(sets[a] & sets[b])


def test_slices_keep_whole_rows():
    texts = ["x" * 700_000, "", None, "short", "y" * 10]
    batch = pa.record_batch({"text": pa.array(texts)})
    got = list(slices(iter([batch]), "text", 100_000))
    assert [t for part, _, _ in got for t in part.column("text").to_pylist()] == texts
    assert [part.num_rows for part, _, _ in got] == [1, 4]


def test_texts_of_rich_structure_get_different_hashes():
    """The words that collide under every polynomial modulo a power of two, and long equal runs."""
    pairs = []
    for length in (64, 512, 1024, 2048, 4096):
        parity = [bin(i).count("1") & 1 for i in range(length)]
        pairs += ["".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity), "a" * length, "a" * (length + 1)]
    data, offsets = buffer(pa.array(pairs))
    found = span_hashes(data, offsets[:-1], offsets[1:])
    assert len(set(found.tolist())) == len(set(pairs))
    assert not set(found.tolist()) & set(span_hashes(data, offsets[:-1], offsets[1:], seed=1).tolist())
    twice = np.concatenate([data, data])
    assert (span_hashes(twice, offsets[:-1] + len(data), offsets[1:] + len(data)) == found).all()
    assert max(np.diff(offsets)) > LONG > min(np.diff(offsets))
