"""Benchmark passages in documents, found by latent semantic retrieval.

1. Terms are the folded words of the benchmark items. How many corpus passages (runs of
   ``PASSAGE`` words) hold each term is counted over all documents. Terms in more than
   ``STOP_SHARE`` of the passages carry no weight, except that every item keeps at least
   its ``KEEP_TERMS`` rarest.
2. A latent space comes from a randomised SVD of the TF-IDF matrix whose rows are the
   pieces of items (``PIECE`` words at most, repeated to weigh as much as the corpus) and
   all corpus passages. One job adds up the products of the rows' terms, pair by pair, in
   whole numbers; the sums are a matrix of terms by terms. Spark multiplies it with a thin
   random matrix, twice more with its own result (power iteration), and the driver only
   sees terms x rank matrices, whose size follows the block of items and not the corpus.
3. Every window of 2 * STRIDE words of every document is projected into the space, and
   (window, item) pairs with cosine of ``COSINE`` or more are candidates. The cosine is
   taken with the window's norm before projection: what lies outside the space counts.
4. A candidate is checked on the words: the longest common subsequence of the item and the
   text around the window. ``EXACT`` of the item's words or more is a leak; ``PARAPHRASE``
   or more is one if the answer is there too: all words of ``answer``, if the benchmark has
   such a column, else two thirds of the item's ``KEY_TERMS`` rarest words.

Items are taken in blocks of at most ``ITEM_BLOCK`` items and ``RANK - SPARE`` pieces, each
against all documents, so what is broadcast has a fixed bound, and the space has a direction
for every piece. An item of more pieces is a block of its own, and its space grows with it.
Items are checked whole. Null and empty texts hold nothing; items without words are ignored; repeated rows and items give repeated results; a null doc_id or item_id is
reported as null. Empty tables give empty results. Extra columns are left aside
(``leaks``) or passed on (``decontaminated``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from forespell.llm.components import written
from forespell.llm.ship import give_back
from forespell.llm.words import buffer, slices, words

PASSAGE = 32
STRIDE = 8
PIECE = 48
ITEM_BLOCK = 800
RANK = 1_024
SPARE = 32
STOP_SHARE = 0.02
KEEP_TERMS = 6
KEY_TERMS = 3
COSINE = 0.4
EXACT = 0.8
PARAPHRASE = 0.6
#: Parts of one in which products of weights are added up.
UNIT = 1 << 30
#: Pairs of terms that a task holds, and lines of their matrix that it multiplies at once.
PAIRS = 2_000_000
STRIP = 256


@dataclass
class Vocabulary:
    terms: np.ndarray

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes that are terms, and which terms."""
        near = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[near]), max(len(self.terms) - 1, 0))
        hit = self.terms[at] == hashes[near] if len(self.terms) else np.zeros(0, bool)
        return near[hit], at[hit]


@dataclass
class Items:
    """Benchmark items as word hashes, with their answers' words."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray | None]


def read_items(benchmark: DataFrame) -> Items:
    """The items on the driver (the caller passes one block)."""
    answer = "answer" if "answer" in benchmark.columns else None
    rows = benchmark.select("item_id", "text", *([answer] if answer else [])).collect()

    def hashed(texts: list) -> list[np.ndarray]:
        data, offsets = buffer(pa.array(texts, pa.string()))
        found = words(data, offsets, fold=True, bare=True)
        return [found.hash[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]

    texts = hashed([r["text"] for r in rows])
    answers = hashed([r["answer"] for r in rows]) if answer else [None] * len(rows)
    use = [k for k, w in enumerate(texts) if len(w)]
    return Items([rows[k]["item_id"] for k in use], [texts[k] for k in use], [a if (a := answers[k]) is not None and len(a) else None for k in use])


def passage_counts(documents: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int, DataFrame]:
    """Passages holding each term, all passages, and the terms of every passage.

    A row of the last has the passages of a slice of documents: ``terms`` of one after another, ``sizes``.
    """
    size = len(vocabulary.terms)
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    ints = pa.list_(pa.int32())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for part, data, offsets in slices(batches, "text"):
            found = words(data, offsets, fold=True, bare=True)
            count = np.diff(found.first)
            runs = -(-count // PASSAGE)
            total[-1] += runs.sum()
            at, term = shared.value.find(found.hash)
            if not len(at):
                continue
            doc = found.doc[at]
            passage = (np.cumsum(runs) - runs)[doc] + (at - found.first[doc]) // PASSAGE
            once = np.unique(passage * size + term)
            total[:-1] += np.bincount(once % size, minlength=size)
            _, n = np.unique(once // size, return_counts=True)
            lists = {"terms": pa.array([(once % size).astype(np.int32)], ints), "sizes": pa.array([n.astype(np.int32)], ints)}
            yield pa.record_batch({"term": pa.array([None], pa.int64()), "n": pa.array([None], pa.int64()), **lists})
        some = np.flatnonzero(total)
        none = pa.array([None] * len(some), ints)
        yield pa.record_batch({"term": pa.array(some), "n": pa.array(total[some]), "terms": none, "sizes": none})

    found = written(documents.select("text").mapInArrow(rows, "term long, n long, terms array<int>, sizes array<int>"), "passages")
    counts = np.zeros(size + 1, np.int64)
    for row in found.filter("n is not null").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return counts[:-1], int(counts[-1]), found.filter("n is null").select("terms", "sizes")


def weights(items: list[np.ndarray], vocabulary: Vocabulary, counts: np.ndarray, passages: int) -> np.ndarray:
    """idf of each term; 0 for stop terms that no item needs."""
    idf = np.log((passages + 1) / (counts + 1)) + 0.1
    keep = counts <= STOP_SHARE * passages
    for item in items:
        _, at = vocabulary.find(np.unique(item))
        keep[at[np.argsort(-idf[at], kind="stable")[:KEEP_TERMS]]] = True
    return np.where(keep, idf, 0.0)


def cut(item: np.ndarray) -> list[np.ndarray]:
    """An item in equal pieces of at most PIECE words."""
    return np.array_split(item, max(1, -(-len(item) // PIECE)))


def pair_sums(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """``term, others, sums``: A^T A by rows, for the TF-IDF rows A of unit length in ``terms, sizes, copies``.

    A product of two weights is a whole number of 1 / ``UNIT``, so the sums do not depend on their order.
    """
    size = len(idf)
    shared = rows.sparkSession.sparkContext.broadcast(idf)

    def merged(codes: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
        return codes[first], np.add.reduceat(sums[order], first) if len(first) else sums

    def batch_of(codes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"term": pa.array((codes // size).astype(np.int32)), "other": pa.array((codes % size).astype(np.int32)), "sum": pa.array(sums)})

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        nothing = np.zeros(0, np.int64)
        held, fresh, waiting = (nothing, nothing), [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                flat = batch.column("terms")[k].values.to_numpy()
                sizes = batch.column("sizes")[k].values.to_numpy()
                row = np.repeat(np.arange(len(sizes)), sizes)
                kept = w[flat] > 0
                flat, row = flat[kept].astype(np.int64), row[kept]
                n = np.bincount(row, minlength=len(sizes))
                value = w[flat] / np.sqrt(np.bincount(row, w[flat] ** 2, len(sizes)))[row]
                first = (np.cumsum(n) - n)[row]
                # every term of a passage with every term of it
                left = np.repeat(np.arange(len(flat)), n[row])
                right = np.arange(len(left)) - np.repeat(np.cumsum(n[row]) - n[row], n[row]) + first[left]
                product = np.rint(value[left] * value[right] * UNIT).astype(np.int64) * batch.column("copies")[k].as_py()
                fresh.append(merged(flat[left] * size + flat[right], product))
                waiting += len(fresh[-1][0])
                if waiting > PAIRS:
                    held = merged(*(np.concatenate(x) for x in zip(held, *fresh, strict=True)))
                    fresh, waiting = [], 0
                    if len(held[0]) > PAIRS:
                        yield batch_of(*held)
                        held = (nothing, nothing)
        held = merged(*(np.concatenate(x) for x in zip(held, *fresh, strict=True)))
        for low in range(0, len(held[0]), 1 << 16):
            yield batch_of(held[0][low : low + (1 << 16)], held[1][low : low + (1 << 16)])

    pairs = rows.mapInArrow(job, "term int, other int, sum long").groupBy("term", "other").agg(F.sum("sum").alias("sum"))
    listed = pairs.groupBy("term").agg(F.sort_array(F.collect_list(F.struct("other", "sum"))).alias("found"))
    return written(listed.select("term", F.col("found.other").alias("others"), F.col("found.sum").alias("sums")), "pairs")


def latent_space(pairs: DataFrame, size: int, rank: int = RANK, power: int = 2) -> np.ndarray:
    """terms x rank: the leading right singular vectors of the TF-IDF rows whose pair sums are given.

    Randomised range finding; every product with the matrix is one Spark job over ``pairs``.
    """
    width = min(rank + 16, size)
    context = pairs.sparkSession.sparkContext

    def product(basis: np.ndarray) -> np.ndarray:
        shared = context.broadcast(basis.astype(np.float32))

        def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, STRIP):
                    part = batch.slice(low, STRIP)
                    others, sums = part.column("others"), part.column("sums")
                    strip = np.zeros((part.num_rows, size), np.float32)
                    line = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(others.offsets)))
                    strip[line, np.asarray(others.flatten())] = np.asarray(sums.flatten()) / UNIT
                    lines = [x.tobytes() for x in strip @ shared.value]
                    yield pa.record_batch({"term": part.column("term"), "line": pa.array(lines, pa.binary())})

        out = np.zeros((size, width))
        for r in pairs.mapInArrow(job, "term int, line binary").toLocalIterator():
            out[r["term"]] = np.frombuffer(r["line"], np.float32)
        return out

    basis = np.random.default_rng(3).normal(size=(size, width))
    for _ in range(1 + power):
        basis, _ = np.linalg.qr(product(basis))
    _, turn = np.linalg.eigh(basis.T @ product(basis))
    return (basis @ turn[:, ::-1])[:, :rank]


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    places: dict[int, int] = {}
    for k, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | (1 << k)
    every = (1 << len(item)) - 1
    open_ = every
    for word in text.tolist():
        if met := places.get(word):
            at = open_ & met
            open_ = ((open_ + at) | (open_ - at)) & every
    return len(item) - open_.bit_count()


class Searcher:
    """Finds the items of one block in the texts of a slice."""

    def __init__(self, items: Items, vocabulary: Vocabulary, idf: np.ndarray, space: np.ndarray) -> None:
        self.items, self.idf = items, idf
        used = np.flatnonzero(idf)
        self.vocabulary = Vocabulary(vocabulary.terms[used])
        self.project = (space * idf[:, None])[used].astype(np.float32)
        self.square = (idf[used] ** 2).astype(np.float32)
        pieces, owner, self.keys = [], [], []
        for k, item in enumerate(items.words):
            for part in cut(item):
                _, at = self.vocabulary.find(np.unique(part))
                if len(at):
                    latent = self.project[at].sum(axis=0)
                    pieces.append(latent / max(float(np.linalg.norm(latent)), 1e-9))
                    owner.append(k)
            _, at = vocabulary.find(np.unique(item))
            self.keys.append(vocabulary.terms[at[np.argsort(-idf[at], kind="stable")[:KEY_TERMS]]])
        self.owner = np.array(owner, np.int64)
        self.pieces = np.stack(pieces) if pieces else np.zeros((0, space.shape[1]), np.float32)
        # The most a term can add to the product with any piece.
        self.reach = np.zeros(len(used), np.float32)
        for low in range(0, len(used) if pieces else 0, 1024):
            self.reach[low : low + 1024] = np.maximum((self.project[low : low + 1024] @ self.pieces.T).max(axis=1), 0)
        self.distinct = [np.unique(item) for item in items.words]

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(row, item, cosine, common words, first word of the stretch looked at)."""
        found = words(data, offsets, fold=True, bare=True)
        at, term = self.vocabulary.find(found.hash)
        if not len(at) or not len(self.owner):
            return []
        doc = found.doc[at]
        runs = -(-np.diff(found.first) // STRIDE)
        base = np.cumsum(runs + 1) - (runs + 1)
        step = (at - found.first[doc]) // STRIDE
        # Window s of a text covers the stretches s - 1 and s.
        window = np.concatenate([base[doc] + step, base[doc] + step + 1])
        size = len(self.vocabulary.terms)
        once = np.unique(window * size + np.concatenate([term, term]))
        window, start = np.unique(once // size, return_index=True)
        leaks: dict[tuple[int, int], list] = {}
        terms, count = once % size, np.diff(np.append(start, len(once)))
        # A window's norm is that of its TF-IDF vector, so one shared word alone is not near.
        norm = np.sqrt(np.add.reduceat(self.square[terms], start))
        # No cosine exceeds the sum of what the terms can add at most: few windows need projection.
        far = np.add.reduceat(self.reach[terms], start) < COSINE * norm
        picked = np.flatnonzero(~far)
        for low in range(0, len(picked), 8192):
            some = picked[low : low + 8192]
            n = count[some]
            at_window = np.cumsum(n) - n
            mine = terms[np.repeat(start[some] - at_window, n) + np.arange(n.sum())]
            cosine = (np.add.reduceat(self.project[mine], at_window) / norm[some, None]) @ self.pieces.T
            for w, p in zip(*np.nonzero(cosine >= COSINE), strict=True):
                row = int(np.searchsorted(base, window[some[w]], "right")) - 1
                step_at = int(window[some[w]] - base[row]) - 1
                leaks.setdefault((row, int(self.owner[p])), []).append((step_at, float(cosine[w, p])))
        out = []
        for (row, k), windows in sorted(leaks.items()):
            if checked := self._check(found.hash[found.first[row] : found.first[row + 1]], k, windows):
                out.append((row, k, max(c for _, c in windows), *checked))
        return out

    def _check(self, text: np.ndarray, k: int, windows: list[tuple[int, float]]) -> tuple[int, int] | None:
        item = self.items.words[k]
        answer = self.items.answers[k]
        best = None
        done = -1
        for step, _ in sorted(windows):
            low = max(0, step * STRIDE - len(item))
            high = min(len(text), (step + 2) * STRIDE + len(item))
            if high <= done:
                continue
            done = high
            stretch = text[low:high]
            every = self.distinct[k]
            met = stretch[every[np.minimum(np.searchsorted(every, stretch), len(every) - 1)] == stretch]
            if len(met) < PARAPHRASE * len(item):
                continue
            common = common_subsequence(item, met)
            if common < PARAPHRASE * len(item) or (best and best[0] >= common):
                continue
            if common < EXACT * len(item):
                need = np.unique(answer) if answer is not None else self.keys[k]
                there = np.isin(need, stretch).sum()
                if there < (len(need) if answer is not None else 2 * len(need) / 3):
                    continue
            best = (common, low)
        return best


def item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The items that have words, in blocks of at most ITEM_BLOCK items and RANK - SPARE pieces."""
    most_items, most_pieces = ITEM_BLOCK, RANK - SPARE
    columns = ["item_id", "text", *(["answer"] if "answer" in benchmark.columns else [])]
    chosen = benchmark.select(*columns)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            n = -(-np.diff(words(data, offsets, fold=True, bare=True).first) // PIECE)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], [*part.schema.names, "pieces"])

    def dealt(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        block, items, pieces, out = -1, 0, 0, []
        for n in group.column("pieces").to_pylist():
            if n > pieces or not items:
                block, items, pieces = block + 1, most_items, most_pieces
            items, pieces = items - 1, pieces - n
            out.append(block)
        return group.append_column("block", pa.array(out, pa.int64()))

    longs = lambda schema, *names: StructType([*schema.fields, *(StructField(n, LongType()) for n in names)])
    items = written(chosen.mapInArrow(counted, longs(chosen.schema, "pieces")).filter("pieces > 0"), "items")
    n = items.agg(F.count("*").alias("items"), F.sum("pieces").alias("pieces")).first()
    if not n["items"]:
        return []
    if n["items"] <= most_items and n["pieces"] <= most_pieces:
        return [items.select(*columns)]
    # A group of some thirty blocks is dealt by one task; repeated items are spread by their place.
    groups = -(-max(n["items"] // most_items, n["pieces"] // most_pieces) // 32) or 1
    placed = items.withColumn("place", F.xxhash64("item_id", "text", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.pmod("place", F.lit(groups)))
    found = written(placed.groupBy("part").applyInArrow(dealt, longs(placed.schema, "block")), "blocks")
    names = sorted((r["part"], r["block"]) for r in found.select("part", "block").distinct().collect())
    return [found.filter((F.col("part") == part) & (F.col("block") == block)).select(*columns) for part, block in names]


def searchers(documents: DataFrame, benchmark: DataFrame) -> Iterator[Searcher]:
    """One searcher for each block of items."""
    spark = documents.sparkSession
    for block in item_blocks(benchmark):
        items = read_items(block)
        vocabulary = Vocabulary(np.unique(np.concatenate(items.words)))
        counts, passages, lists = passage_counts(documents, vocabulary)
        idf = weights(items.words, vocabulary, counts, passages)
        pieces = [np.unique(vocabulary.find(part)[1]).tolist() for w in items.words for part in cut(w)]
        # Repeated, the items' pieces count as much as the corpus: their directions are the ones asked for.
        again = max(1, passages // len(pieces))
        asked = spark.createDataFrame([(sum(pieces, []), [len(p) for p in pieces], again)], "terms array<int>, sizes array<int>, copies long")
        pairs = pair_sums(lists.withColumn("copies", F.lit(1).cast("long")).union(asked), idf)
        found = Searcher(items, vocabulary, idf, latent_space(pairs, len(idf), len(pieces) + SPARE))
        give_back()
        yield found


def _search(documents: DataFrame, searcher: Searcher) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(searcher)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            ids, items = part.column("doc_id").to_pylist(), shared.value.items
            for row, k, cosine, common, low in shared.value.find(data, offsets):
                out = {"doc_id": ids[row], "item_id": items.ids[k], "cosine": cosine, "common_words": common, "item_words": len(items.words[k]), "near_word": low}
                yield pa.RecordBatch.from_pylist([out], SCHEMA)

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, item_id long, cosine double, common_words int, item_words int, near_word long")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("common_words", pa.int32()), ("item_words", pa.int32()), ("near_word", pa.int64())])


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and the evidence, for every document row that holds a benchmark item."""
    found = [_search(documents, searcher) for searcher in searchers(documents, benchmark)]
    empty = documents.sparkSession.createDataFrame([], "doc_id long, item_id long, cosine double, common_words int, item_words int, near_word long")
    out = found[0] if found else empty
    for more in found[1:]:
        out = out.union(more)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, with all their columns."""
    for searcher in searchers(documents, benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(searcher)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in slices(batches, "text"):
                keep = np.ones(part.num_rows, bool)
                keep[[hit[0] for hit in shared.value.find(data, offsets)]] = False
                yield part.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
