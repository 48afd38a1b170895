"""Quality scores by Bradley-Terry pairwise ranking.

A document's features describe the form of its whole text (marks, capitals, digits,
repetition, word lengths). The model learns weights from preference pairs: for a pair
(good, bad) the probability that good wins is ``sigmoid(w . (f_good - f_bad))``, fitted by
logistic loss on feature differences. Scores then need a threshold: the quantile of the
training scores at the share of bad labels. ``score = sigmoid(w . f - threshold)``, so
0.5 is the threshold.

Labels of at most ``max_labelled`` rows, those with the smallest hash of doc_id, reach the
driver as feature rows (a documented bound of the fit alone); scoring reads every text.
Empty and null texts have all features at 0 and get a score like any other text. Rows
with null doc_id are scored but never learned from; label rows with null labels are
ignored; repeated labels of a document count by their smallest value. Without both
classes among the labels the score is the constant share of good ones (1 if there are
none). An empty table gives an empty result. Extra columns are left aside, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.llm.ship import give_back
from forespell.llm.words import per_row, slices, words

_MARKS = b"!?|%$#&*@^~=+<>{}[]\\/_"
_CLASSES = {
    "upper": range(ord("A"), ord("Z") + 1),
    "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "line": b"\n",
    "plain": b".,;:'\"()-",
    "wide": range(128, 256),
    "bang": b"!",
    "bar": b"|",
    "marks": _MARKS,
}
_TABLES = {name: np.isin(np.arange(256), list(chars)).astype(np.int32) for name, chars in _CLASSES.items()}
FEATURES = [*_TABLES, "word_length", "long_words", "odd_ends", "capital_words", "repeats", "length", "some"]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text, all between 0 and about 1."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    full = np.maximum(size, 1)
    out = np.zeros((rows, len(FEATURES)))
    for k, table in enumerate(_TABLES.values()):
        out[:, k] = per_row(np.add, table[data], offsets) / full
    found = words(data, offsets)
    count = np.maximum(np.diff(found.first), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return per_row(np.add, flags.astype(np.int64), found.first) / count

    length = found.end - found.start
    if len(length):
        last, head = data[found.end - 1], data[found.start]
        capital = (_TABLES["upper"][head] > 0) & (_TABLES["upper"][data[np.minimum(found.start + 1, found.end - 1)]] > 0)
        order = np.lexsort((found.hash, found.doc))
        same = np.zeros(len(order), bool)
        same[1:] = (found.hash[order][1:] == found.hash[order][:-1]) & (found.doc[order][1:] == found.doc[order][:-1])
        flags = [np.minimum(length, 40) / 20, length > 12, _TABLES["marks"][last] > 0, capital & (length > 1)]
        for k, flag in enumerate(flags, len(_TABLES)):
            out[:, k] = share(flag) if flag.dtype == bool else per_row(np.add, flag.astype(float), found.first) / count
        out[:, len(_TABLES) + 4] = per_row(np.add, same.astype(np.int64), found.first) / count
    out[:, -2] = np.log1p(size) / 20
    out[:, -1] = size > 0
    return out


@dataclass(frozen=True)
class QualityModel:
    """Weights of the standardised features, and the threshold on w . f."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = self.expanded((rows - self.centre) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    @staticmethod
    def expanded(rows: np.ndarray) -> np.ndarray:
        """The features and their saturating squares: both too little and too much can be bad."""
        rows = np.clip(rows, -6, 6)
        return np.hstack([rows, np.minimum(rows**2, 9.0)])


def fit(rows: np.ndarray, good: np.ndarray, pairs: int = 200_000, steps: int = 400, l2: float = 1e-3) -> QualityModel:
    """Bradley-Terry weights from ``pairs`` preference pairs drawn among the labelled rows."""
    if not len(rows) or good.min() == good.max():
        share = float(good.mean()) if len(good) else 1.0
        logit = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        width = rows.shape[1]
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(2 * width), -logit)
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
    x = QualityModel.expanded((rows - centre) / scale)
    draw = np.random.default_rng(7)
    won, lost = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    diff = x[draw.choice(won, pairs)] - x[draw.choice(lost, pairs)]
    w, m, v = np.zeros(x.shape[1]), 0.0, 0.0
    for step in range(1, steps + 1):
        part = diff[(step * 4096) % pairs :][:4096]
        lose = 1 / (1 + np.exp(np.clip(part @ w, -500, 500)))
        grad = -(part * lose[:, None]).mean(axis=0) + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    ranked = np.sort(x @ w)
    cut = int((good == 0).sum())
    return QualityModel(centre, scale, w, float((ranked[cut - 1] + ranked[min(cut, len(ranked) - 1)]) / 2))


def bounded_sample(labels: DataFrame, label: str, trains: Column, most: int) -> DataFrame:
    """At most ``most`` labelled rows, those with the smallest hash of doc_id: doc_id, label."""
    usable = labels.filter(trains & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    one = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train(documents: DataFrame, labels: DataFrame, trains: Column, label: str = "quality", max_labelled: int = 20_000) -> QualityModel:
    """Learn from the labelled rows for which ``trains`` (a condition on doc_id) holds."""
    sample = bounded_sample(labels, label, trains, max_labelled)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            out = features(data, offsets)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "label": part.column("label"), "f": pa.array(list(out), pa.list_(pa.float64()))})

    got = texts.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, f array<double>").toPandas()
    got = got.sort_values(["doc_id"], kind="stable")
    x = np.stack(got["f"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    model = fit(x, got["label"].to_numpy())
    del got
    give_back()
    return model


def score(documents: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score, predicted for every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            s = model.scores(features(data, offsets))
            yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))})

    return documents.select("doc_id", "text").mapInArrow(rows, "doc_id long, score double, predicted int")


def accepted(documents: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``documents`` with a score of 0.5 or more, with all their columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            yield part.filter(pa.array(model.scores(features(data, offsets)) >= 0.5))

    return documents.mapInArrow(rows, documents.schema)
