"""Cross-entropy difference: how much more a target model than a background model expects a text.

Two bigram models share one vocabulary, all words of both corpora and an end sign. They are
matched: background counts are scaled to the size of the target corpus, so both models
smooth alike. With s the scale, c the counts in the target and s * c in the background,

    q(w)   = (c_target(w) + s c_background(w) + 0.01) / (2 N_target + 1)
    p(w)   = (c(w) + KAPPA q(w)) / (N + KAPPA)
    p(w|v) = (c(v, w) + MU p(w)) / (c(v) + MU)

and a document's score is the mean over its tokens (end sign included) of the loss
``-ln p(w|v)`` under the target less that under the background: lower is nearer to the
target. Documents of the background are scored without their own counts.

The logarithm of p(w|v) parts into one term that needs the counts of (v, w) and w and one
that needs those of v. So one shuffle of all tokens by word suffices: the task that holds
all occurrences of w knows c(w) and c(v, w), and adds both the terms of w as a word and as
the context of what follows. Tokens travel in packed blocks, results as one number for each
document and task.

Words and pairs with a share of ``HEAVY`` or more of all tokens (at most 1 / HEAVY of each,
which bounds their broadcast) do not: two scans count them exactly beforehand. Tokens of
heavy words go to tasks by pair, with how often their own text has the word, and heavy pairs
are scored where they are read. So a word, line or passage that is everywhere makes no task
larger. Which words are heavy decides where the sums are made and not what they are.

Null and empty texts consist of the end sign alone. Rows with null doc_id are counted and
scored like others, so are repeated rows (each counts). With an empty target or no
documents all scores are 0 or the result is empty. Extra columns are left aside. Texts of
any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import written
from forespell.llm.words import mix, slices, words

HEAVY = 1e-4
MU = 20.0
KAPPA = 1000.0
FLOOR = 0.01
BEGIN = np.uint64(0x243F6A8885A308D3)
END = np.uint64(0x13198A2E03707344)
#: Tokens a task holds before it sends them on.
HELD = 2_000_000
#: Tokens a part has at most on average, so that the largest task does not grow with the corpus.
PART_TOKENS = 4_000_000


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and row of every token, the end sign of each text included."""
    found = words(data, offsets, fold=True)
    rows = len(offsets) - 1
    n = np.diff(found.first) + 1
    ends = np.cumsum(n) - 1
    word = np.full(int(n.sum()), END)
    inner = np.ones(len(word), bool)
    inner[ends] = False
    word[inner] = found.hash
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[ends - n + 1] = BEGIN
    return word, context, np.repeat(np.arange(rows), n)


def pair(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word * np.uint64(3) + context)


class Heavy:
    """Exact counts (target, background) of heavy words and pairs, by hash."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Position of each hash, -1 if it is not heavy."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def _items(word: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
    return [word, pair(word, context)]


def heavy_counts(corpora: list[DataFrame]) -> tuple[list[Heavy], np.ndarray, np.ndarray]:
    """Heavy words and pairs with their counts in each corpus; tokens and texts of each corpus."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A share of HEAVY of all tokens is one of at least HEAVY in some slice.
        seen: list[dict[int, int]] = [{}, {}]
        total = 0
        for _, data, offsets in slices(batches, "text"):
            word, context, _ = tokens(data, offsets)
            total += len(word)
            for kind, items in enumerate(_items(word, context)):
                values, n = np.unique(items, return_counts=True)
                often_here = n >= max(2, HEAVY * len(word))
                for item, k in zip(values[often_here].tolist(), n[often_here].tolist(), strict=True):
                    seen[kind][item] = seen[kind].get(item, 0) + k
        yield pa.record_batch({"kind": pa.array([2], pa.int32()), "item": pa.array([0], pa.int64()), "n": pa.array([total], pa.int64())})
        for kind in (0, 1):
            if seen[kind]:
                yield pa.record_batch({"kind": pa.array([kind] * len(seen[kind]), pa.int32()), "item": pa.array(np.array(list(seen[kind]), np.uint64).view(np.int64)), "n": pa.array(list(seen[kind].values()))})

    named = [c.select("text").mapInArrow(often, "kind int, item long, n long") for c in corpora]
    candidates = written(named[0].union(named[1]).groupBy("kind", "item").agg(F.sum("n").alias("n")), "candidates")
    # These sums are lower bounds: what is heavy twice over reaches a quarter of HEAVY for
    # certain, and at most 4 / HEAVY items can.
    every = candidates.filter("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often_enough = candidates.filter((F.col("kind") < 2) & (F.col("n") >= HEAVY / 4 * every)).collect()
    chosen = [np.sort(np.array([r["item"] for r in often_enough if r["kind"] == kind], np.int64).view(np.uint64)) for kind in (0, 1)]
    spark = corpora[0].sparkSession
    shared = spark.sparkContext.broadcast(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [Heavy(keys, np.zeros(len(keys))) for keys in shared.value]
        sums = [np.zeros(len(keys), np.int64) for keys in shared.value]
        total = texts = 0
        for part, data, offsets in slices(batches, "text"):
            word, context, _ = tokens(data, offsets)
            total, texts = total + len(word), texts + part.num_rows
            for heavy, held, items in zip(lists, sums, _items(word, context), strict=True):
                at = heavy.find(items)
                held += np.bincount(at[at >= 0], minlength=len(held))
        for kind, held in enumerate([*sums, np.array([total, texts])]):
            some = np.flatnonzero(held)
            yield pa.record_batch({"kind": pa.array([kind] * len(some), pa.int32()), "at": pa.array(some), "n": pa.array(held[some])})

    counts = [np.zeros((len(keys), 2)) for keys in chosen] + [np.zeros((2, 2))]
    for side, corpus in enumerate(corpora):
        for row in corpus.select("text").mapInArrow(count, "kind int, at long, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
            counts[row["kind"]][row["at"], side] = row["n"]
    sizes, texts = counts[2]
    out = []
    for keys, n in zip(chosen, counts, strict=False):
        keep = n.sum(axis=1) >= HEAVY * max(1.0, sizes.sum())
        out.append(Heavy(keys[keep], n[keep]))
    return out, sizes, texts


def pair_terms(c_pair: np.ndarray, c_word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """ln(c(v, w) + MU p(w)) of the background less that of the target; counts are (target, background)."""
    scale = sizes[0] / max(sizes[1], 1.0)
    target, behind = c_word[:, 0], scale * c_word[:, 1]
    q = (target + behind + FLOOR) / (2 * sizes[0] + 1)
    p = [(c + KAPPA * q) / (sizes[0] + KAPPA) for c in (target, behind)]
    return np.log(scale * c_pair[:, 1] + MU * p[1]) - np.log(c_pair[:, 0] + MU * p[0])


def context_terms(c_word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """ln(c(v) + MU) of the target less that of the background."""
    scale = sizes[0] / max(sizes[1], 1.0)
    return np.log(c_word[:, 0] + MU) - np.log(scale * c_word[:, 1] + MU)


def group_counts(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of rows by keys (first key outermost), and the number of each row's group in that order."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        k = key[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.cumsum(new)


def _home(names: np.ndarray, parts: int) -> np.ndarray:
    """The part that adds up a document; its name is its task and its place in the task."""
    return (mix(names + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def _short(values: np.ndarray) -> np.ndarray:
    """In 16 bits if they fit, else in 32."""
    return values.astype(np.uint16 if values.max(initial=0) < 1 << 16 else np.uint32)


def _join(first: int, second: int, arrays: list[np.ndarray]) -> bytes:
    """Two numbers and some arrays of unsigned numbers, in one block."""
    head = np.array([first, second, len(arrays), *[a.itemsize << 40 | len(a) for a in arrays]], np.int64)
    return b"".join(a.tobytes() for a in (head, *arrays))


def _part(data: bytes) -> tuple[int, int, list[np.ndarray]]:
    first, second, count = np.frombuffer(data, np.int64, 3).tolist()
    at, arrays = 8 * (3 + count), []
    for entry in np.frombuffer(data, np.int64, count, 24).tolist():
        size, length = entry >> 40, entry & ((1 << 40) - 1)
        arrays.append(np.frombuffer(data[at : at + size * length], f"<u{size}"))
        at += size * length
    return first, second, arrays


def _pack(word: np.ndarray, context: np.ndarray, doc: np.ndarray, own: np.ndarray, side: int) -> bytes:
    """Rows sorted by word and context; contexts by place in a list, documents (numbers that rise in a task) by distance from the first."""
    order = np.lexsort((context, word))
    keys, n = np.unique(word, return_counts=True)
    low = int(doc.min())
    listed, place = np.unique(context[order], return_inverse=True)
    arrays = [keys, _short(n), listed, _short(place), _short((doc - np.uint64(low))[order])]
    if own.any():
        arrays.append(_short(own[order]))
    return _join(side, low, arrays)


def _unpack(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Side, words, contexts, documents and own counts (0 where the word is not heavy)."""
    side, low, (keys, n, listed, place, doc, *own) = _part(data)
    counts = own[0] if own else np.zeros(len(place), np.uint16)
    return side, np.repeat(keys, n), listed[place], doc.astype(np.uint64) + np.uint64(low), counts.astype(np.uint32)


SCHEMA = "part int, payload binary, name long, doc_id long, n_tokens long, value double"
_ARROW = pa.schema([("part", pa.int32()), ("payload", pa.binary()), ("name", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("value", pa.float64())])


def _send(corpus: DataFrame, side: int, parts: int, shared) -> DataFrame:
    """Tokens in packed blocks by part; for the scored side also a row per document with what is known of it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (heavy_words, heavy_pairs), sizes, texts = shared.value
        task = TaskContext.get().partitionId()
        seen = 0
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            word, context, doc, own = (np.concatenate(x) for x in zip(*held, strict=True))
            route = np.where(own > 0, pair(word, context), word)
            # Heavy and other words in blocks of their own: only the former carry counts.
            part = (mix(route) % np.uint64(parts)).astype(np.int64) * 2 + (own > 0)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(2 * parts + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[k] : cuts[k + 1]]
                yield pa.RecordBatch.from_pylist([{"part": int(k) // 2, "payload": _pack(word[mine], context[mine], doc[mine], own[mine], side)}], _ARROW)
            held.clear()

        for batch, data, offsets in slices(batches, "text"):
            word, context, row = tokens(data, offsets)
            names = (np.uint64(task) << np.uint64(32)) + np.arange(seen, seen + batch.num_rows, dtype=np.uint64)
            seen += batch.num_rows
            at = heavy_pairs.find(pair(word, context))
            there = np.flatnonzero(at >= 0)

            def own(items: np.ndarray, rows: np.ndarray) -> np.ndarray:
                """How often each item is in its own text."""
                order, group = group_counts([rows, items])
                out = np.empty(len(items), np.int64)
                out[order] = np.bincount(group)[group] if len(group) else 0
                return out

            own_word = np.zeros(len(word), np.int64)
            often = np.flatnonzero(heavy_words.find(word) >= 0)
            own_word[often] = own(word[often], row[often])
            if side == 1:
                value = np.zeros(batch.num_rows)
                if len(there):
                    w = heavy_words.find(word[there])  # the word of a heavy pair is heavy
                    c_pair, c_word = heavy_pairs.counts[at[there]].copy(), heavy_words.counts[w].copy()
                    c_pair[:, 1] -= own(pair(word, context)[there], row[there])
                    c_word[:, 1] -= own_word[there]
                    terms = pair_terms(c_pair, c_word, sizes) + np.where(word[there] == END, 0.0, context_terms(c_word, sizes))
                    value += np.bincount(row[there], terms, batch.num_rows)
                value += context_terms(np.array([[texts[0], texts[1] - 1]]), sizes)[0]
                n = np.bincount(row, minlength=batch.num_rows)
                to = _home(names, parts).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.nulls(len(n), pa.binary()), pa.array(names.view(np.int64)), batch.column("doc_id"), pa.array(n), pa.array(value)], schema=_ARROW)
            rest = np.flatnonzero(at < 0)
            held.append((word[rest], context[rest], names[row[rest]], own_word[rest].astype(np.uint32)))
            waiting += len(rest)
            if waiting >= HELD:
                yield from blocks()
                waiting = 0
        if held:
            yield from blocks()

    return corpus.select("doc_id", "text").mapInArrow(rows, SCHEMA)


def _evaluate(blocks: list[bytes], shared, parts: int) -> Iterator[pa.RecordBatch]:
    """All tokens of one part: the sum of their terms for each document, packed by where its row is."""
    (heavy_words, _), sizes, _ = shared.value
    got = [_unpack(b) for b in blocks]
    word, context, doc, own_heavy = (np.concatenate([g[k] for g in got]) for k in (1, 2, 3, 4))
    side = np.repeat([g[0] for g in got], [len(g[1]) for g in got])
    del got
    order = np.lexsort((doc, context, word))
    word, context, doc, side, own_heavy = word[order], context[order], doc[order], side[order], own_heavy[order]

    def starts(*keys: np.ndarray) -> np.ndarray:
        new = np.ones(len(word), bool)
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        return np.cumsum(new) - 1

    of_word, of_pair = starts(word), starts(word, context)
    both = [np.stack([np.bincount(g, side == 0), np.bincount(g, side == 1)], axis=1) for g in (of_word, of_pair)]
    heavy = heavy_words.find(word)
    c_word = both[0][of_word]
    c_word[heavy >= 0] = heavy_words.counts[heavy[heavy >= 0]]
    c_pair = both[1][of_pair]
    mine = starts(word, context, doc)
    c_pair[:, 1] -= np.bincount(mine)[mine]
    by_doc, group = group_counts([word, doc])
    own = np.empty(len(word))
    own[by_doc] = np.bincount(group)[group]
    c_word[:, 1] -= np.where(heavy >= 0, own_heavy, own)
    keep = side == 1
    c_word, c_pair = np.maximum(c_word[keep], 0), np.maximum(c_pair[keep], 0)
    terms = pair_terms(c_pair, c_word, sizes) + np.where(word[keep] == END, 0.0, context_terms(c_word, sizes))
    names, inverse = np.unique(doc[keep], return_inverse=True)
    sums = np.bincount(inverse, terms, len(names))
    to = _home(names, parts)
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        mine = order[cuts[k] : cuts[k + 1]]
        tasks, n = np.unique(names[mine] >> np.uint64(32), return_counts=True)
        arrays = [tasks.astype(np.uint32), n.astype(np.uint32), names[mine].astype(np.uint32), sums[mine].astype(np.float32).view(np.uint32)]
        yield pa.RecordBatch.from_pylist([{"part": int(k), "payload": _join(0, 0, arrays)}], _ARROW)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[pa.RecordBatch]]]:
    """Rows sorted by part, one part at a time: its payloads and its document rows."""
    part, blocks, docs = None, [], []
    for batch in batches:
        numbers = np.asarray(batch.column("part"))
        edges = np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1 if len(numbers) else 0))
        for a, b in zip(edges, np.append(edges[1:], len(numbers)), strict=True):
            if numbers[a] != part:
                if part is not None:
                    yield part, blocks, docs
                part, blocks, docs = int(numbers[a]), [], []
            piece = batch.slice(a, b - a)
            blocks += [p for p in piece.column("payload").to_pylist() if p is not None]
            docs.append(piece.filter(piece.column("payload").is_null()))
    if part is not None:
        yield part, blocks, docs


def score(documents: DataFrame, target: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_tokens, score for every document; ``target`` has a column text.

    ``parts`` is the number of tasks that share the tokens: by default two for each shuffle
    partition, and more if a part would have above ``PART_TOKENS``.
    """
    spark = documents.sparkSession
    aimed = target.select(F.lit(None).cast("long").alias("doc_id"), "text")
    heavy, sizes, texts = heavy_counts([aimed, documents])
    parts = parts or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(sizes.sum() / PART_TOKENS))
    if not sizes[0]:
        sizes = np.array([1.0, sizes[1]])
    shared = spark.sparkContext.broadcast((heavy, sizes, texts))
    sent = _send(aimed, 0, parts, shared).union(_send(documents, 1, parts, shared))

    def evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blocks, docs in _by_part(batches):
            yield from docs
            if blocks:
                yield from _evaluate(blocks, shared, parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blocks, docs in _by_part(batches):
            rows = pa.Table.from_batches(docs)
            name = np.asarray(rows.column("name")).view(np.uint64)
            order = np.argsort(name)
            total = np.asarray(rows.column("value")).copy()
            for block in blocks:
                tasks, n, low, sums = _part(block)[2]
                named = (np.repeat(tasks, n).astype(np.uint64) << np.uint64(32)) + low
                total[order[np.searchsorted(name, named, sorter=order)]] += sums.view(np.float32)
            n_tokens = np.asarray(rows.column("n_tokens"))
            mean = np.where(n_tokens > 0, total / np.maximum(n_tokens, 1), 0.0)
            for batch in pa.table({"doc_id": rows.column("doc_id"), "n_tokens": rows.column("n_tokens"), "score": pa.array(mean)}).to_batches():
                yield batch

    met = sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(evaluate, SCHEMA)
    home = met.repartition(parts, "part").sortWithinPartitions("part")
    return home.mapInArrow(add, "doc_id long, n_tokens long, score double")
