"""Toxicity scores by a convolutional text classifier, trained in numpy.

A word (folded, parted at marks) is embedded as the sum of three rows of a hashed
table: that of the word and those of its first four and five bytes, so that inflected
forms share what their stem has learned. A row is a hash modulo ``BUCKETS``; row 0
stands for all that the training sample does not know, so a rare word never borrows
the row of a known one. Filters of widths
1, 2 and 3 slide over the whole text, the largest answer of each filter is kept (max
pooling), and a logistic layer turns those into a logit. Training runs on the driver
over at most ``max_labelled`` labelled texts (a documented bound of the fit alone);
scoring runs over whole texts in tasks that hold one slice of a batch.

Thresholds are calibrated by language: the language is guessed from function words of
the text itself (never from a column), and each language's logits are shifted so that
its best training threshold lies at ``AT`` = 0.3.

Empty and null texts score like a text of unknown words. Rows with null doc_id are
scored but never learned from; null labels are ignored; of repeated labels the smallest
counts. With a single class among the labels the score is that class's share, with no
labels 0. Empty tables give empty results; extra columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.llm.quality import bounded_sample
from forespell.llm.ship import give_back
from forespell.llm.words import LOWER, Words, mix, slices, span_hashes, word_hashes, words

BUCKETS = 1 << 16
#: Bytes from the start of a word that are hashed; 0 is the whole word.
STEMS = (0, 4, 5)
WIDTHS = (1, 2, 3)
FILTERS = 6
SIZE = 6
AT = 0.3
LEAST_TEXTS = 5
#: Frequent function words of four languages.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "that", "with", "for", "is"],
    "fr": ["le", "les", "des", "et", "une", "dans", "est", "pour"],
    "de": ["der", "die", "und", "ist", "den", "nicht", "mit", "von"],
    "es": ["el", "los", "las", "una", "por", "con", "que", "del"],
}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Lookup:
    """Which hashes the training sample knows."""

    known: np.ndarray
    maybe: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known >> np.uint64(44)).astype(np.int64)] = True

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The embedding row of each hash, in the same shape."""
        shape, hashes = hashes.shape, hashes.ravel()
        out = np.zeros(len(hashes), np.int32)
        if len(self.known):
            near = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
            found = hashes[near]
            at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
            hit = self.known[at] == found
            out[near[hit]] = 1 + (found[hit] % np.uint64(BUCKETS)).astype(np.int32)
        return out.reshape(shape)


def parts(data: np.ndarray, found: Words) -> np.ndarray:
    """Hashes of each word and its stems: one row per word, one column per STEMS."""
    columns = [found.hash]
    for size in STEMS[1:]:
        stem = span_hashes(data, found.start, np.minimum(found.end, found.start + size), LOWER)
        columns.append(mix(stem + np.uint64(size)))
    return np.stack(columns, axis=1)


def padded(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's rows followed by two rows 0, and where the texts start."""
    count = np.diff(first)
    start = first + 2 * np.arange(len(first))
    out = np.zeros((start[-1], len(STEMS)), np.int32)
    out[np.arange(len(rows)) + np.repeat(2 * np.arange(len(count)), count)] = rows
    return out, start


def language(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """0..3 for the language with most function words in a text, 4 if it has none."""
    names = list(FUNCTION_WORDS)
    table = {int(h): k for k, name in enumerate(names) for h in word_hashes(FUNCTION_WORDS[name])}
    keys = np.array(sorted(table), np.uint64)
    kinds = np.array([table[int(h)] for h in keys])
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == hashes)
    doc = np.searchsorted(first, hit, "right") - 1
    rows = len(first) - 1
    votes = np.bincount(doc * len(names) + kinds[at[hit]], minlength=rows * len(names)).reshape(rows, len(names))
    return np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(names))


@dataclass
class ToxicityModel:
    """The trained net, folded into one table: an embedding row's answer in each place of each filter."""

    lookup: Lookup
    answers: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    shift: np.ndarray

    def pooled(self, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
        each = self.answers[ids[:, 0]]
        for stem in range(1, len(STEMS)):
            each += self.answers[ids[:, stem]]
        got = []
        column = 0
        for k, width in enumerate(WIDTHS):
            total = each[:, column : column + FILTERS]
            column += FILTERS
            for step in range(1, width):
                total[:-step] += each[step:, column : column + FILTERS]
                column += FILTERS
            got.append(np.maximum(np.maximum.reduceat(total, start[:-1], axis=0) + self.bias[k], 0))
        return np.hstack(got)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        found = words(data, offsets, fold=True, bare=True)
        ids, start = padded(self.lookup.rows(parts(data, found)), found.first)
        logit = self.pooled(ids, start) @ self.out + self.out_bias
        return _sigmoid(logit + self.shift[language(found.hash, found.first)])


def _known(hashes: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` words in most texts, of those in LEAST_TEXTS at least."""
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, count = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True)
    rank = np.lexsort((values, -count))[:most]
    rank = np.sort(rank[count[rank] >= LEAST_TEXTS])
    return values[rank], count[rank]


def fit(hashes: list[np.ndarray], toxic: np.ndarray, vocabulary: int = 100_000, epochs: int = 4, batch: int = 48) -> ToxicityModel:
    """Train on the hashes of the words and stems of labelled texts (see ``parts``)."""
    known, _ = _known(hashes, vocabulary)
    lookup = Lookup(known)
    languages = len(FUNCTION_WORDS) + 1
    places = sum(WIDTHS)
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0
        flat = np.zeros((BUCKETS + 1, places * FILTERS), np.float32)
        return ToxicityModel(lookup, flat, np.zeros((len(WIDTHS), FILTERS)), np.zeros(len(WIDTHS) * FILTERS), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), np.zeros(languages))
    texts = [lookup.rows(h) for h in hashes]
    draw = np.random.default_rng(11)
    seen = np.zeros((2, BUCKETS + 1))
    for ids, label in zip(texts, toxic, strict=True):
        seen[label][np.unique(ids)] += 1
    share = toxic.mean()
    odds = np.log((seen[1] + 5 * share) / toxic.sum()) - np.log((seen[0] + 5 * (1 - share)) / (1 - toxic).sum())
    # The first coordinate starts as the log odds of the word's row: it has to be learned from few texts.
    emb = draw.normal(0, 0.1, (BUCKETS + 1, SIZE)).astype(np.float32)
    emb[:, 0] = np.clip(odds, -3, 5) / 3
    emb[0] = 0
    filters = [draw.normal(0, 0.1, (width * SIZE, FILTERS)).astype(np.float32) for width in WIDTHS]
    for w in filters:
        w[0] += 0.7
    params = [emb, *filters, np.zeros((len(WIDTHS), FILTERS), np.float32), np.full(len(WIDTHS) * FILTERS, 0.3, np.float32), np.array([-2.0], np.float32)]
    dense_m = [np.zeros_like(p) for p in params[1:]]
    dense_v = [np.zeros_like(p) for p in params[1:]]
    emb_v = np.full(BUCKETS + 1, 1e-3, np.float32)
    step = 0
    for _ in range(epochs):
        for part in np.array_split(draw.permutation(len(texts)), max(1, len(texts) // batch)):
            step += 1
            ids, start = padded(np.concatenate([texts[i] for i in part]), np.concatenate([[0], np.cumsum([len(texts[i]) for i in part])]))
            y = toxic[part]
            bias, out = params[-3], params[-2]
            x = emb[ids].sum(axis=1)
            pooled, where = [], []
            for k, width in enumerate(WIDTHS):
                z = np.zeros((len(ids), FILTERS), np.float32)
                for j in range(width):
                    z[: len(ids) - j] += x[j:] @ filters[k][j * SIZE : (j + 1) * SIZE]
                top = np.maximum.reduceat(z, start[:-1], axis=0)
                doc = np.repeat(np.arange(len(part)), np.diff(start))
                hit_at, hit_f = np.nonzero(z == top[doc])
                spot = np.zeros((len(part), FILTERS), np.int64)
                spot[doc[hit_at][::-1], hit_f[::-1]] = hit_at[::-1]
                pooled.append(np.maximum(top + bias[k], 0))
                where.append(spot)
            h = np.hstack(pooled)
            delta = ((_sigmoid(h @ out + params[-1][0]) - y) / len(part)).astype(np.float32)
            grads = [None] * (len(params) - 1)
            grads[-1] = np.array([delta.sum()])
            grads[-2] = h.T @ delta + 1e-4 * out
            back = np.outer(delta, out) * (h > 0)
            grads[-3] = np.zeros_like(bias)
            touched: list[np.ndarray] = []
            pulls: list[np.ndarray] = []
            for k, width in enumerate(WIDTHS):
                d = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads[-3][k] = d.sum(axis=0)
                grad = np.zeros_like(filters[k])
                for j in range(width):
                    at = np.minimum(where[k] + j, len(ids) - 1)
                    rows = x[at]
                    grad[j * SIZE : (j + 1) * SIZE] = np.einsum("nfs,nf->sf", rows, d)
                    pull = (d[:, :, None] * filters[k][j * SIZE : (j + 1) * SIZE].T[None]).reshape(-1, SIZE)
                    for stem in range(len(STEMS)):
                        touched.append(ids[at, stem].ravel())
                        pulls.append(pull)
                grads[k] = grad + 1e-4 * filters[k]
            rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            pull = np.zeros((len(rows), SIZE), np.float32)
            np.add.at(pull, inverse, np.concatenate(pulls))
            emb_v[rows] += (pull**2).mean(axis=1)
            emb[rows] -= 0.02 * pull / np.sqrt(emb_v[rows])[:, None]
            emb[0] = 0
            for k, grad in enumerate(grads):
                dense_m[k] = 0.9 * dense_m[k] + 0.1 * grad
                dense_v[k] = 0.99 * dense_v[k] + 0.01 * grad**2
                params[k + 1] -= 0.01 * (dense_m[k] / (1 - 0.9**step)) / (np.sqrt(dense_v[k] / (1 - 0.99**step)) + 1e-7)
    answers = np.hstack([emb @ filters[k][j * SIZE : (j + 1) * SIZE] for k, width in enumerate(WIDTHS) for j in range(width)])
    model = ToxicityModel(lookup, answers.astype(np.float32), params[-3], params[-2], float(params[-1][0]), np.zeros(languages))
    logits = np.zeros(len(texts))
    spoken = np.zeros(len(texts), np.int64)
    for low in range(0, len(texts), batch):
        part = range(low, min(low + batch, len(texts)))
        first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in part])])
        ids, start = padded(np.concatenate([texts[i] for i in part]), first)
        logits[low : part.stop] = model.pooled(ids, start) @ model.out + model.out_bias
        spoken[low : part.stop] = language(np.concatenate([hashes[i][:, 0] for i in part]), first)
    model.shift = np.array([np.log(AT / (1 - AT)) - best_cut(logits[spoken == k], toxic[spoken == k], logits, toxic) for k in range(languages)])
    return model


def best_cut(logits: np.ndarray, toxic: np.ndarray, all_logits: np.ndarray, all_toxic: np.ndarray) -> float:
    """The logit with fewest errors; a language without 20 texts of either class takes that of all."""
    if min((toxic == 1).sum(), (toxic == 0).sum()) < 20:
        logits, toxic = all_logits, all_toxic
    order = np.argsort(logits, kind="stable")
    z, y = logits[order], toxic[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    at = best[len(best) // 2]
    low, high = z[max(at - 1, 0)], z[min(at, len(z) - 1)]
    return float((low + high) / 2)


def train(documents: DataFrame, labels: DataFrame, trains: Column, label: str = "toxic", max_labelled: int = 2_500) -> ToxicityModel:
    """Learn from the labelled rows for which ``trains`` (a condition on doc_id) holds."""
    sample = bounded_sample(labels, label, trains, max_labelled)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            found = words(data, offsets, fold=True, bare=True)
            hashes = parts(data, found)
            flat = [hashes[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
            yield pa.record_batch({"doc_id": part.column("doc_id"), "label": part.column("label"), "words": pa.array(flat, pa.binary())})

    got = texts.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, words binary").toPandas()
    got = got.sort_values(["doc_id"], kind="stable")
    model = fit([np.frombuffer(w, np.uint64).reshape(-1, len(STEMS)) for w in got["words"]], got["label"].to_numpy())
    del got
    give_back()
    return model


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted for every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            s = shared.value.scores(data, offsets)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= AT).astype(np.int32))})

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double, predicted int")


def accepted(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``documents`` with a score below AT, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            yield part.filter(pa.array(shared.value.scores(data, offsets) < AT))

    return documents.mapInArrow(rows, documents.schema)
