"""Words of whole texts as 64-bit hashes, for Arrow batches.

The texts of a batch lie one after another in one UTF-8 buffer. Words, shingles
and their hashes come from array operations on that buffer, so a task costs a few
nanoseconds per byte. A text is never cut; a slice of a batch holds whole rows.

A word is a longest run of bytes other than ``\\x20`` and ``\\x09-\\x0D``. The hash
of a span takes eight bytes at a time into a 64-bit state that is mixed after each
step (BLAKE2 for spans above ``LONG`` bytes), so no structure of the bytes makes hashes
agree: different spans do so with the chance of 64 random bits (a pair among a million
with 3e-8).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from forespell.llm.ship import give_back

#: Bytes of text that one slice should hold; a single longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_AS_IS = np.arange(256, dtype=np.uint8)
LOWER = _AS_IS.copy()
LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
#: Spans above so many bytes are hashed one by one.
LONG = 1024
#: The low k bytes of eight.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words(NamedTuple):
    """The words of some texts: ``doc`` is the row in the slice, ``start``/``end`` are bytes of ``data``."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    #: Words of row r are those from first[r] to first[r + 1].
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of them."""
    return _powers(1 << max(16, (int(size) - 1).bit_length()))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class PrefixSums:
    """Hashes of many overlapping short spans: a polynomial modulo 2**64.

    For spans of up to some hundred bytes only (pieces of a vocabulary); longer ones can
    be made to collide, see ``span_hashes``.
    """

    def __init__(self, data: np.ndarray, table: np.ndarray = _AS_IS) -> None:
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((table.astype(np.uint64) + np.uint64(1))[data] * up[: len(data)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each span ``data[start:end]`` (none empty)."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = _AS_IS, seed: int = 0) -> np.ndarray:
    """Hash of each span ``data[start:end]`` after ``table``; other seeds give independent hashes."""
    if table is not _AS_IS:
        data = table[data]
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = end - start
    out = (left + seed).astype(np.uint64) * np.uint64(_BASE)
    long = np.flatnonzero(left > LONG)
    active, state, at = np.flatnonzero(left <= LONG), out, start
    if len(long):
        key = seed.to_bytes(8, "little", signed=True)
        out[long] = [int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8, key=key).digest(), "little") for i in long.tolist()]
        state, at, left = out[active], start[active], left[active]
    while len(active):
        state = mix(state ^ (eight[at] & _LOW_BYTES[np.minimum(left, 8)]))
        out[active] = state
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
        state = state[more] * np.uint64(0xD6E8FEB86659FD93)
    return out


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = False, bare: bool = False, seed: int = 0) -> Words:
    """All words of the texts; ``fold`` hashes A-Z as a-z, ``bare`` also parts words at ASCII marks."""
    inside = ~(_MARK if bare else _SPACE)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(span_hashes(data, start, end, LOWER if fold else _AS_IS, seed), doc, start, end, first)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``size`` words; a shorter text has its whole sequence as one."""
    count = np.diff(found.first)
    n = np.where(count == 0, 0, np.maximum(count - size + 1, 1))
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(found.first[:-1], n)
    length = np.repeat(np.minimum(count, size), n)
    out = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    last = max(len(found.hash) - 1, 0)
    for k in range(size):
        more = k < length
        step = found.hash[np.minimum(at + k, last)] if len(found.hash) else found.hash
        out = np.where(more, mix(out * np.uint64(_BASE) + step), out)
    return out, doc


def distinct(values: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and where each row's values start."""
    order = np.lexsort((values, doc)) if len(values) else np.zeros(0, np.int64)
    values, doc = values[order], doc[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    values, doc = values[keep], doc[keep]
    return values, np.searchsorted(doc, np.arange(rows + 1))


def per_row(ufunc: np.ufunc, values: np.ndarray, first: np.ndarray, empty: float = 0) -> np.ndarray:
    """Reduce the values of each row; rows without values get ``empty``."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = ufunc.reduceat(values, first[full])
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of whole rows of about ``size`` bytes: the rows, their bytes, their offsets."""
    for batch in batches:
        data, offsets = buffer(batch.column(text))
        row = 0
        while row < batch.num_rows:
            past = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
            past = min(max(past, row + 1), batch.num_rows)
            low, high = offsets[row], offsets[past]
            yield batch.slice(row, past - row), data[low:high], offsets[row : past + 1] - low
            row = past
    # workers wait for the next task, of whatever stage, with what the largest batch took
    batch = data = offsets = None
    give_back()


def word_hashes(texts: list[str]) -> np.ndarray:
    """The folded hash of each of some single words."""
    data, offsets = buffer(pa.array(texts, pa.string()))
    return words(data, offsets, fold=True).hash


def packed(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and row starts."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
