"""Substring dedup: repeated windows of words, found level by level.

A window of ``size`` words can only be repeated if its parts are. So windows of a short
length are counted first; those repeated are extended to twice that length (or as far as two
overlapping halves reach), and so on up to ``size``: 4, 7, 13. Levels below ``size`` look at
a sample that cannot miss: each window of ``size`` words is represented by that window
inside it whose hash is least, so equal windows are represented alike. A window stays
alive while its representatives are repeated; each level sends only what lies in windows
still alive, and when none survive, the later levels have no rows.

A word is covered if some window over it also starts in a document with a smaller doc_id.
Windows are judged on the input, not on what is left.

How it runs:

* A text that also occurs under a smaller doc_id is covered wholly (or, if it is shorter
  than a window, not at all). Such copies are found by SHA-256 and send no windows.
* Windows travel as hashes. A task first looks within its slice of texts: what repeats there
  is settled there, and one row for each window goes on. So a window in a third of all
  documents is one row for each slice, not for each document; settled rows are dealt by
  document. The rest are dealt by hash, and looked at in the exchange they came by.
* The last level decides with two independent 64-bit hashes, the second cut to 32 bits.
  Earlier levels, which only sift, use one.
* Texts are shuffled by doc_id once; all levels read that exchange.

Null texts have no words. Rows with null doc_id are neither smaller nor greater than others:
they keep all words and cover none. Several rows under one doc_id do not cover each other.
Extra columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forespell.llm.components import written
from forespell.llm.words import mix, per_row, slices, words

#: The first level is at most so long.
START = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Rows of a window: seen once in its slice; least of several there; settled in its slice.
ONCE, LEAST, SETTLED = 0, 1, 2


def lengths(size: int) -> list[int]:
    """Window lengths by level, each at most twice the one before: 13 gives 4, 7, 13."""
    out = [size]
    while out[0] > START:
        out.insert(0, (out[0] + 1) // 2)
    return out


def grown(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values, by doubling; entry i starts at i."""
    have, out = 1, hashes
    while have < size:
        step = min(have, size - have)
        out = mix(out[: len(out) - step] * _STEP + out[step:] + np.uint64(step)) if len(out) > step else out[:0]
        have += step
    return out


def least_of_runs(values: np.ndarray, run: int) -> np.ndarray:
    """Where the least of each run of ``run`` neighbours stands (of equal ones the last), by doubling."""
    least, at, have = values, np.arange(len(values)), 1
    while have < run and len(least):
        step = min(have, run - have)
        later = least[step:] <= least[: len(least) - step]
        least, at, have = np.where(later, least[step:], least[: len(least) - step]), np.where(later, at[step:], at[: len(at) - step]), have + step
    return at


class Texts:
    """The words of a slice; texts do not run into each other."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: int = 1) -> None:
        self.found = [words(data, offsets, seed=seed) for seed in range(seeds)]
        self.first, self.doc = self.found[0].first, self.found[0].doc

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window at each word (0 where there is none), and whether there is one."""
        here = np.zeros(len(self.doc), bool)
        if len(here) >= size:
            here[: len(here) - size + 1] = self.doc[: len(here) - size + 1] == self.doc[size - 1 :]
        out = np.zeros(len(here), np.uint64)
        hashes = grown(self.found[seed].hash, size)
        out[: len(hashes)] = hashes
        return out, here

    def sampled(self, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the windows of ``length`` words; the starts of windows of ``size`` words; the sampled window in each."""
        hashes = self.windows(length)[0]
        starts = np.flatnonzero(self.windows(size)[1])
        return hashes, starts, least_of_runs(mix(hashes + np.uint64(length)), size - length + 1)[starts]

    def alive(self, length: int, size: int, repeated: list[np.ndarray]) -> np.ndarray:
        """Which windows of ``size`` words (in order) sample a window of ``length`` that is among their text's repeated ones."""
        hashes, starts, at = self.sampled(length, size)
        out = np.zeros(len(starts), bool)
        cuts = np.searchsorted(self.doc[starts], np.arange(len(repeated) + 1)) if len(starts) else np.zeros(len(repeated) + 1, int)
        for row, values in enumerate(repeated):
            low, high = cuts[row], cuts[row + 1]
            if len(values) and high > low:
                out[low:high] = np.isin(hashes[at[low:high]], values)
        return out


def settled(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Kind of each (window, document) of a slice, in order of the window and then the document."""
    kind = np.zeros(len(hashes), np.int8)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    starts = np.flatnonzero(~same)
    if len(starts):
        least = docs[starts][np.cumsum(~same) - 1]
        most = np.maximum.reduceat(docs, starts)
        several = most[np.cumsum(~same) - 1] > least
        kind[several] = np.where(docs[several] > least[several], SETTLED, LEAST)
    return kind


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The values of each row of a list column; null lists are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [np.zeros(0, np.uint64) if not v.is_valid else v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in column]


_WINDOW = "hash long, other int, doc long, variant int, at int, kind byte"


def _window_batch(hashes, other, docs, variants, at) -> pa.RecordBatch:
    """One row for each window and text, at its first place there; ``-1 - at`` says that there are more."""
    order = np.lexsort((at, variants, docs, other, hashes))
    hashes, other, docs, variants, at = (x[order] for x in (hashes, other, docs, variants, at))
    first = np.ones(len(at), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (other[1:] != other[:-1]) | (docs[1:] != docs[:-1]) | (variants[1:] != variants[:-1])
    again = np.zeros(len(at), bool)
    again[:-1] = ~first[1:]
    at = np.where(again, -1 - at, at).astype(np.int32)
    hashes, other, docs, variants, at = (x[first] for x in (hashes, other, docs, variants, at))
    kind = settled(hashes ^ mix(other.astype(np.uint64) + np.uint64(1)), docs)
    back = np.lexsort((np.where(at < 0, -1 - at, at), docs))  # neighbours in a text stay neighbours: shuffled blocks compress
    columns = (hashes.view(np.int64), other, docs, variants, at, kind)
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int8())
    return pa.record_batch({n: pa.array(c[back], t) for n, c, t in zip(("hash", "other", "doc", "variant", "at", "kind"), columns, types, strict=True)})


def _send(level: int, size: int):
    """Windows of a level, from texts and the repeated windows of the level before."""
    length = lengths(size)[level]
    last = length == size

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(iter([batch]), "text"):
                texts = Texts(data, offsets, 2 if last else 1)
                hashes, starts, at = texts.sampled(length, size)
                if level:
                    alive = texts.alive(lengths(size)[level - 1], size, _lists(part.column("repeated")))
                else:
                    copies = zip(part.column("copies").to_pylist(), part.column("variant").to_pylist(), strict=True)
                    alive = ~np.array([c is not None and v in c for c, v in copies], bool)[texts.doc[starts]]
                at = np.unique(at[alive])
                row = texts.doc[at]
                docs, variants = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "variant"))
                found = hashes[at]
                if last:
                    other = (texts.windows(size, 1)[0][at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    yield _window_batch(found, other, docs, variants, (at - texts.first[row]).astype(np.int32))
                else:
                    zeros = np.zeros(len(at), np.int32)
                    yield _window_batch(found, zeros, docs, zeros, zeros)

    return send


def same_windows(texts: Texts, at: np.ndarray, size: int) -> np.ndarray:
    """Where in their texts the windows at ``at`` stand, these places included."""
    hashes, here = texts.windows(size)
    named = mix(hashes ^ mix(texts.doc.astype(np.uint64) + np.uint64(1)))
    return np.flatnonzero(here & np.isin(named, named[at]))


def _digest(size: int):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words, covered words and the hash of the kept ones of each text."""
        for batch in batches:
            for part, data, offsets in slices(iter([batch]), "text"):
                found = words(data, offsets)
                n = np.diff(found.first)
                variants, copies = part.column("variant").to_numpy(zero_copy_only=False), part.column("copies").to_pylist()
                copy = np.array([c is not None and v in c for c, v in zip(copies, variants.tolist(), strict=True)], bool) & (n >= size)
                lists = part.column("covered")
                row = np.repeat(np.arange(len(n)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                spans = lists.flatten()
                at = spans.field("at").to_numpy(zero_copy_only=False)[spans.field("variant").to_numpy(zero_copy_only=False) == variants[row]]
                row = row[spans.field("variant").to_numpy(zero_copy_only=False) == variants[row]]
                at, row = at[~copy[row]], row[~copy[row]]
                again = at < 0
                at = np.where(again, -1 - at, at) + found.first[row]
                if again.any():
                    at = np.append(at, same_windows(Texts(data, offsets), at[again], size))
                words_after = len(found.doc) + 1
                covered = np.bincount(at, minlength=words_after) - np.bincount(at + size, minlength=words_after)
                covered += np.bincount(found.first[:-1][copy], minlength=words_after) - np.bincount(found.first[1:][copy], minlength=words_after)
                gone = np.cumsum(covered)[:-1] > 0
                kept, ends = kept_text(data, found, gone)
                removed = per_row(np.add, gone.astype(np.int64), found.first)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc"),
                        "n_words": pa.array(n, pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "kept": pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(ends), pa.py_buffer(kept)).cast(pa.string()),
                    }
                )

    return digest


def kept_text(data: np.ndarray, found, gone: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of all texts, joined by one space within a text; where each text starts."""
    stay = np.flatnonzero(~gone)
    rows = len(found.first) - 1
    doc = found.doc[stay]
    last = np.ones(len(stay), bool)
    last[:-1] = doc[1:] != doc[:-1]
    size = found.end[stay] - found.start[stay]
    wide = size + ~last
    total = int(wide.sum())
    begin = np.cumsum(wide) - wide
    out = np.full(total, 0x20, np.uint8)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin, size) + step] = data[np.repeat(found.start[stay], size) + step]
    ends = np.zeros(rows + 1, np.int64)
    np.add.at(ends, doc + 1, wide)
    return out.tobytes(), np.cumsum(ends)


def _repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the least and the greatest document of each window, in one exchange."""
    lane = F.when(F.col("kind") == SETTLED, F.col("doc")).otherwise(F.lit(0).cast("long"))
    window = Window.partitionBy(*keys, "lane")
    return rows.withColumn("lane", lane).withColumns({"low": F.min("doc").over(window), "high": F.max("doc").over(window), "most": F.max("kind").over(window)})


def deduplicated(documents: DataFrame, size: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept: each text without the words covered by windows of ``size`` words of smaller documents."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), F.hash(text).alias("variant"))
    usable = docs.filter("doc is not null")
    named = usable.select("doc", "variant", F.sha2(F.col("text").cast("binary"), 256).alias("name"))
    earliest = named.groupBy("name").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    copies = named.join(written(earliest, "copied-texts"), "name").filter("doc > low").groupBy("doc").agg(F.collect_set("variant").alias("copies"))
    rows = usable.join(copies, "doc", "left").select("doc", "variant", "text", "copies")
    levels = lengths(size)
    for level, length in enumerate(levels):
        sent = rows.mapInArrow(_send(level, size), _WINDOW)
        if length == size:
            break
        met = _repeats(sent.select("hash", "doc", "kind"), ["hash"])
        met = met.filter(f"low < high or most > {ONCE}")
        repeated = met.groupBy("doc").agg(F.collect_set("hash").alias("repeated"))
        rows = usable.join(repeated, "doc").select("doc", "variant", "text", "repeated")
    met = _repeats(sent, ["hash", "other"]).filter(f"kind = {SETTLED} or doc > low")
    covered = met.groupBy("doc").agg(F.collect_list(F.struct("variant", "at")).alias("covered"))
    nothing = F.lit(None)
    ready = usable.join(covered, "doc", "left").join(copies, "doc", "left").select("doc", "variant", "text", "copies", "covered")
    nobody = docs.filter("doc is null").select("doc", "variant", "text", nothing.cast("array<int>").alias("copies"), nothing.cast("array<struct<variant:int,at:int>>").alias("covered"))
    return ready.unionByName(nobody).mapInArrow(_digest(size), "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
