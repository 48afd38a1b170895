"""SentencePiece encoding and decoding with the N best segmentations of whole texts.

A text is normalised as the model does (a space in front, spaces as the word mark) and
parted before every run of spaces; no piece of more than one character crosses such a
place, so the piece lattice of a text is a chain of small lattices, one per *chunk*, and
equal chunks of a slice share one.

Forward: Viterbi over all distinct chunks of a slice at once gives, for every position,
the best score from the chunk's start and the second best. Backward: an A* search from
the end of a chunk uses the forward scores as its heuristic. They are exact, so complete
segmentations leave the queue in order of score and nothing is expanded in vain. Of a text,
only the N - 1 chunks whose second best is nearest to their best can differ in its N best
segmentations; only those are searched, and their lists are combined.

A character without a piece of its own becomes byte pieces, so decoding gives back every
text exactly, the word mark U+2581 itself included. Ties go to the longer last piece, then
to the earlier chunk. Null and empty texts have no pieces: one segmentation, score 0. Rows
with null doc_id, repeated rows and texts of any length are encoded like others; an empty
table gives an empty result; extra columns are left aside.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from forespell.llm.words import PrefixSums, buffer, slices, span_hashes

MARK = "▁"
MODEL = "piece_bpe_32k.model"
SPACE = 0x20


class Pieces:
    """The pieces of a model: hash -> id and score."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        usable = [k for k in range(size) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        text = [model.id_to_piece(k).replace(MARK, " ").encode() for k in usable]
        if any(" " in t.decode().strip(" ") or (t.endswith(b" ") and t.strip(b" ")) for t in text):
            raise ValueError("a piece crosses the start of a run of spaces")
        self.bytes_of = [b""] * size
        for k, t in zip(usable, text, strict=True):
            self.bytes_of[k] = t
        byte_ids = [k for k in range(size) if model.is_byte(k)]
        self.byte_id = np.zeros(256, np.int32)
        for k in byte_ids:
            value = int(model.id_to_piece(k)[3:5], 16)
            self.byte_id[value] = k
            self.bytes_of[k] = bytes([value])
        data, offsets = buffer(pa.array(text, pa.binary()))
        hashes = PrefixSums(data).spans(offsets[:-1], offsets[1:])
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(usable, np.int32)[order]
        self.scores = np.array([model.get_score(k) for k in usable])[order]
        # Below every piece of one character, so that bytes only stand in where there is none.
        one = [model.get_score(k) for k in usable if len(model.id_to_piece(k)) == 1]
        self.byte_score = float(min(one) - 10)
        self.lengths = sorted({len(t) for t in text})
        self.slot = np.full(1 << 21, -1, np.int32)
        places = (self.hashes >> np.uint64(43)).astype(np.int64)
        self.slot[places[::-1]] = np.arange(len(places), dtype=np.int32)[::-1]
        self.crowd = int(np.bincount(places).max())
        # Starts of longer pieces: a run of bytes outside this set needs no longer lookups.
        starts = sorted({t[:k] for t in text for k in range(1, len(t))})
        data, offsets = buffer(pa.array(starts, pa.binary()))
        self.longer = np.zeros(1 << 21, bool)
        self.longer[(PrefixSums(data).spans(offsets[:-1], offsets[1:]) >> np.uint64(43)).astype(np.int64)] = True
        self.flat, self.at = buffer(pa.array(self.bytes_of, pa.binary()))

    def find(self, hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and which pieces; ``places`` are their upper bits."""
        near = np.flatnonzero(self.slot[places] >= 0)
        hashes, found = hashes[near], self.slot[places[near]]
        for _ in range(self.crowd - 1):
            found = np.where((self.hashes[found] < hashes) & (found + 1 < len(self.hashes)), found + 1, found)
        hit = self.hashes[found] == hashes
        return near[hit], found[hit]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the pieces, one after another."""
        size = np.diff(self.at)[ids]
        total = int(size.sum())
        step = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        return self.flat[np.repeat(self.at[ids], size) + step]


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """The piece lattices of distinct chunks; chunk c is ``data[first[c]:first[c + 1]]``.

    Node ``first[c] + c + k`` stands before byte k of chunk c.
    """

    def __init__(self, table: Pieces, data: np.ndarray, first: np.ndarray) -> None:
        self.table, self.data, self.first = table, data, first
        size = np.diff(first)
        chunk = np.repeat(np.arange(len(size)), size)
        self.node = np.arange(len(data)) + chunk
        left = first[1:][chunk] - np.arange(len(data))
        single = np.ones(len(data), np.int64)
        single[data >= 0xC0], single[data >= 0xE0], single[data >= 0xF0] = 2, 3, 4
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        covered = np.zeros(len(data), bool)
        src, length, ids, score = [], [], [], []
        at = heads
        sums = PrefixSums(data)
        for n in range(1, table.lengths[-1] + 1):
            at = at[left[at] >= n]
            if not len(at):
                break
            h = sums.spans(at, at + n)
            places = (h >> np.uint64(43)).astype(np.int64)
            near, found = table.find(h, places)
            got = at[near]
            at = at[table.longer[places]]
            covered[got[single[got] == n]] = True
            src.append(got)
            length.append(np.full(len(got), n))
            ids.append(table.ids[found])
            score.append(table.scores[found])
        bare = heads[~covered[heads]]
        src.append(bare)
        length.append(np.minimum(single[bare], left[bare]))
        ids.append(np.full(len(bare), -1, np.int32))
        score.append(table.byte_score * length[-1])
        src, length = np.concatenate(src), np.concatenate(length)
        dst = self.node[src] + length
        place = src - first[chunk[src]] + length
        if len(place) and place.max() < 1 << 18:  # one number holds all three keys
            order = np.argsort((place << 44) | (dst << 8) | (255 - length), kind="stable")
        else:
            order = np.lexsort((src, dst, place))
        self.src, self.dst = self.node[src][order], dst[order]
        self.ids, self.score = np.concatenate(ids)[order], np.concatenate(score)[order]
        self.ends = first[1:] + np.arange(len(size))
        self._forward(place[order], len(data) + len(size))

    def _forward(self, place: np.ndarray, nodes: int) -> None:
        """Best and second-best score up to each node, and the last edge of the best."""
        self.best, self.second = np.full(nodes, -np.inf), np.full(nodes, -np.inf)
        self.best[self.first[:-1] + np.arange(len(self.first) - 1)] = 0.0
        self.edge = np.full(nodes, -1)
        cuts = np.flatnonzero(np.diff(place, prepend=-1))
        for low, high in zip(cuts, np.append(cuts[1:], len(place)), strict=True):
            dst = self.dst[low:high]
            src = self.src[low:high]
            value = self.best[src] + self.score[low:high]
            start = np.flatnonzero(np.diff(dst, prepend=-1))
            group = np.repeat(np.arange(len(start)), np.diff(np.append(start, high - low)))
            top = np.maximum.reduceat(value, start)
            hits = np.flatnonzero(value == top[group])
            pick = np.zeros(len(start), np.int64)
            pick[group[hits][::-1]] = hits[::-1]
            value[pick] = self.second[src[pick]] + self.score[low:high][pick]
            at = dst[start]
            self.best[at], self.edge[at] = top, low + pick
            self.second[at] = np.maximum.reduceat(value, start)

    def edge_ids(self, edge: int) -> list[int]:
        if self.ids[edge] >= 0:
            return [int(self.ids[edge])]
        low = int(np.searchsorted(self.node, self.src[edge]))
        return self.table.byte_id[self.data[low : low + self.dst[edge] - self.src[edge]]].tolist()

    def best_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentation of every chunk, and where each chunk's start."""
        node = self.ends
        chunk = np.arange(len(node))
        chunks, edges = [], []
        while len(node):
            edge = self.edge[node]
            chunks.append(chunk)
            edges.append(edge)
            node = self.src[edge]
            more = self.edge[node] >= 0
            node, chunk = node[more], chunk[more]
        chunk, edge = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, np.int64), np.concatenate(edges[::-1]) if edges else np.zeros(0, np.int64)
        order = np.argsort(chunk, kind="stable")
        chunk, edge = chunk[order], edge[order]
        wide = np.where(self.ids[edge] < 0, self.dst[edge] - self.src[edge], 1)
        out = np.repeat(self.ids[edge], wide)
        if len(fallen := np.flatnonzero(out < 0)):
            step = np.arange(len(out)) - np.repeat(np.cumsum(wide) - wide, wide)
            low = np.searchsorted(self.node, np.repeat(self.src[edge], wide)[fallen])
            out[fallen] = self.table.byte_id[self.data[low + step[fallen]]]
        return out, np.searchsorted(np.repeat(chunk, wide), np.arange(len(self.first)))

    def incoming(self, node: int) -> range:
        if self.edge[node] < 0:
            return range(0)
        low = high = int(self.edge[node])
        while low > 0 and self.dst[low - 1] == node:
            low -= 1
        while high + 1 < len(self.dst) and self.dst[high + 1] == node:
            high += 1
        return range(low, high + 1)

    def nbest(self, chunk: int, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a chunk: (score, ids), best first (A*, backwards)."""
        start, end = int(self.first[chunk]) + chunk, int(self.ends[chunk])
        queue = [(-self.best[end], 0, end, 0.0, None)]
        out, order = [], 0
        while queue and len(out) < n:
            _, _, node, tail, path = heapq.heappop(queue)
            if node == start:
                ids: list[int] = []
                while path:
                    ids += self.edge_ids(path[0])
                    path = path[1]
                out.append((tail, ids))
                continue
            # Of equal scores the newest leaves first, the longest piece at that: ties are
            # followed to the start one by one and not side by side.
            for edge in reversed(self.incoming(node)):
                order -= 1
                behind = tail + self.score[edge]
                source = int(self.src[edge])
                heapq.heappush(queue, (-(self.best[source] + behind), order, source, behind, (edge, path)))
        return out


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with a space in front of each, where chunks start in them, and each text's first chunk."""
    full = np.flatnonzero(np.diff(offsets))
    data = np.insert(data, offsets[full], SPACE)
    shift = np.zeros(len(offsets), np.int64)
    shift[1:] = np.cumsum(np.diff(offsets) > 0)
    offsets = offsets + shift
    space = data == SPACE
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[offsets[:-1][full]] = True
    start = np.flatnonzero(opens)
    return data, np.append(start, len(data)), np.searchsorted(start, offsets)


def best_of_text(deltas: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` cheapest choices of one entry from each list of losses (each list starts with 0 and rises).

    Ties go to the choice with the smaller places, the first list's first. Every choice but the
    first has one parent, with one less at its last place above 0; the parent is never dearer and
    comes earlier in ties, so a choice need not be in the heap before its parent has left it.
    """
    rising = [list(accumulate(d, max)) for d in deltas]
    heap: list[tuple[float, tuple[int, ...], int]] = [(0.0, (0,) * len(rising), 0)]
    out = []
    while heap and len(out) < n:
        lost, pick, last = heapq.heappop(heap)
        out.append((lost, pick))
        for at in range(last, len(rising)):
            if pick[at] + 1 < len(rising[at]):
                child = (*pick[:at], pick[at] + 1, *pick[at + 1 :])
                heapq.heappush(heap, (sum(d[k] for d, k in zip(rising, child, strict=True)), child, at))
    return out


def encode_slice(table: Pieces, data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, list[tuple[float, np.ndarray]], bool]]:
    """For each text: ids, the n best (score, ids), and whether decoding gave back the text."""
    data, start, first = _chunks(data, offsets)
    if not len(data):
        for _ in range(len(offsets) - 1):
            yield np.zeros(0, np.int32), [(0.0, np.zeros(0, np.int32))], True
        return
    hashes = span_hashes(data, start[:-1], start[1:])
    _, sample, kind = np.unique(hashes, return_index=True, return_inverse=True)
    size = (start[1:] - start[:-1])[sample]
    low = np.cumsum(size) - size
    buf = data[np.repeat(start[:-1][sample], size) + np.arange(size.sum()) - np.repeat(low, size)]
    lattice = Lattice(table, buf, np.append(low, size.sum()))
    ids, at = lattice.best_ids()
    ends = lattice.ends
    best, loss = lattice.best[ends], lattice.best[ends] - lattice.second[ends]
    count = np.diff(at)[kind]
    begin = np.append(0, np.cumsum(count))
    flat = ids[np.repeat(at[:-1][kind], count) + np.arange(begin[-1]) - np.repeat(begin[:-1], count)]
    lists: dict[int, list[tuple[float, list[int]]]] = {}
    back = table.decode(flat)
    size_back = np.append(0, np.cumsum(np.diff(table.at)[flat]))
    same = len(back) == len(data) and bool((back == data).all())
    for row in range(len(first) - 1):
        a, b = int(first[row]), int(first[row + 1])
        mine = flat[begin[a] : begin[b]]
        kinds = kind[a:b]
        total = float(best[kinds].sum())
        losses = loss[kinds]
        near = np.argpartition(losses, n - 2)[: n - 1] if 1 < n <= len(losses) else np.arange(len(losses) if n > 1 else 0)
        if 1 < n <= len(losses):  # equal losses: the earlier chunks
            limit = losses[near].max()
            sure, tied = np.flatnonzero(losses < limit), np.flatnonzero(losses == limit)
            near = np.sort(np.concatenate([sure, tied[: n - 1 - len(sure)]]))
        near = [int(x) for x in near if np.isfinite(losses[x])]
        for x in near:
            if int(kinds[x]) not in lists:
                lists[int(kinds[x])] = lattice.nbest(int(kinds[x]), n)
        options = [lists[int(kinds[x])] for x in near]
        out = []
        for lost, pick in best_of_text([[o[0][0] - s for s, _ in o] for o in options], n):
            parts, done = [], begin[a]
            for x, k, option in zip(near, pick, options, strict=True):
                if k:
                    parts += [flat[done : begin[a + x]], np.array(option[k][1], np.int32)]
                    done = begin[a + x + 1]
            out.append((total - lost, np.concatenate([*parts, flat[done : begin[b]]]).astype(np.int32)))
        text_ok = same or bool(np.array_equal(back[size_back[begin[a]] : size_back[begin[b]]], data[start[a] : start[b]]))
        yield mine, out, text_ok


def encode(documents: DataFrame, n: int = 1, path: str | None = None) -> DataFrame:
    """doc_id, ids, nbest, decoded: the best segmentation, the ``n`` best with their scores, and
    whether decoding the best gave back the text."""
    where = path or public_tokenizers.path(MODEL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            got = list(encode_slice(pieces(where), data, offsets, n))
            nbest = [[{"score": s, "ids": i} for s, i in best] for _, best, _ in got]
            kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))
            yield pa.record_batch({"doc_id": part.column("doc_id"), "ids": pa.array([i for i, _, _ in got], pa.list_(pa.int32())), "nbest": pa.array(nbest, kind), "decoded": pa.array([ok for _, _, ok in got], pa.bool_())})

    schema = "doc_id long, ids array<int>, nbest array<struct<score: double, ids: array<int>>>, decoded boolean"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids (null ids: empty)."""
    where = path or public_tokenizers.path(MODEL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = [bytes(pieces(where).decode(np.array(i or [], np.int64)))[1:].decode() for i in part.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": part.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def digest(documents: DataFrame, n: int = 3, path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, score, ids_crc32, nbest_scores, nbest_crc32, decoded.

    The checksums are crc32 of the ids as little-endian unsigned 32-bit integers;
    ``decoded`` tells whether decoding the best ids gave back the text.
    """
    where = path or public_tokenizers.path(MODEL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            got = [(len(i), best[0][0], crc32(i.astype("<u4").tobytes()), [s for s, _ in best], [crc32(x.astype("<u4").tobytes()) for _, x in best], ok) for i, best, ok in encode_slice(pieces(where), data, offsets, n)]
            cols = list(zip(*got, strict=True)) if got else [[]] * 6
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["doc_id", "n_pieces", "score", "ids_crc32", "nbest_scores", "nbest_crc32", "decoded"])

    schema = "doc_id long, n_pieces long, score double, ids_crc32 long, nbest_scores array<double>, nbest_crc32 array<long>, decoded boolean"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)
