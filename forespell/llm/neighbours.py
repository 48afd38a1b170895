"""Nearest neighbours by collision-counting hashing with query-centred windows.

Each of ``PROJECTIONS`` random lines has one array of all projected vectors, sorted. A
query opens a window around its own projection on every line: the two places in the sorted
array where it ends. A vector whose place lies between them collides there. Virtual
rehashing widens all windows together, radius by radius; the radii before the one where
the query before it stopped are passed over. A vector at distance r or less collides on a line with
probability of ``P(|N(0,1)| <= 1)`` at least when the radius is r, so vectors whose number
of collisions reaches the threshold (that mean less ``SLACK`` standard deviations) are
verified by their exact inner product. A query is done when its k-th best verified vector
lies within the radius, or the windows cover everything.

Largest inner product becomes smallest distance by dividing all vectors by the largest norm
and adding a coordinate that makes them unit vectors; queries are normalised.

Vectors are dealt into blocks of about ``BLOCK``, queries into groups of about ``GROUP``,
and every block meets every group in one task (a stated query set against all rows). Of
vectors equal in all components a block keeps the k + 1 with the smallest ids: by the tie
rule no other can be among the k nearest. The best k of each block are merged by a window
whose limit applies before its shuffle.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows with null vec_id. Equal rows count once; different vectors under one id are all
candidates (and none for each other). Vectors meet only others of their own dimension.
Queries without candidates have no rows; empty tables give empty results; extra columns are
left aside. ``recall`` on the test tables is measured against brute force in tests/llm.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forespell.llm.components import written

PROJECTIONS = 32
SLACK = 3.0
#: P(|N(0,1)| <= 1)
WITHIN = math.erf(1 / math.sqrt(2))
RADII = [0.04 * 1.2**k for k in range(24)]
BLOCK = 16_384
GROUP = 8_192
#: Above the error of an inner product of unit vectors in single precision, up to some ten thousand dimensions.
ROUGH = 1e-3


def threshold() -> int:
    return math.ceil(PROJECTIONS * WITHIN - SLACK * math.sqrt(PROJECTIONS * WITHIN * (1 - WITHIN)))


def inner_products(vectors: np.ndarray, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Of some rows with the query, each summed alike: equal vectors give equal numbers."""
    return np.einsum("ij,j->i", np.take(vectors, rows, axis=0), query)


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, largest: float) -> None:
        self.vectors = vectors
        unit = vectors / largest
        rest = np.sqrt(np.maximum(0.0, 1 - (unit**2).sum(axis=1)))
        lines = np.random.default_rng(5).normal(size=(vectors.shape[1] + 1, PROJECTIONS))
        projected = np.hstack([unit, rest[:, None]]) @ lines
        self.lines = lines[:-1]
        self.largest = largest
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=0).T.copy()
        #: Place of each vector in the sorted array of each line; a block has less than 2**16 vectors.
        self.place = np.empty((PROJECTIONS, len(vectors)), np.uint16)
        np.put_along_axis(self.place, order.T, np.arange(len(vectors), dtype=np.uint16)[None, :], axis=1)
        self.start = 0
        self.rough = unit.astype(np.float32)

    def best_of(self, rows: np.ndarray, query: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` that may be among the ``k`` best and not below ``least``, and their exact inner products.

        Single precision sifts, with a margin far above its rounding; what is left is exact.
        """
        norm = float(np.sqrt((query**2).sum()))
        rough = np.take(self.rough, rows, axis=0) @ (query / norm).astype(np.float32)
        floor = least / (self.largest * norm)
        if len(rows) > k:
            floor = max(floor, float(np.partition(rough, len(rows) - k)[len(rows) - k]))
        rows = rows[rough >= floor - ROUGH]
        return rows, inner_products(self.vectors, rows, query)

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many windows of places ``low`` to ``high``, one for each line, each vector lies."""
        # below the window the unsigned difference wraps round to a large number
        return ((self.place - low[:, None]) < (high - low)[:, None]).sum(axis=0, dtype=np.uint8)

    def search(self, queries: np.ndarray, allowed, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ``k`` best verified (positions, inner products).

        Collisions only grow with the radius, so a query may start with the radius before the
        one where the query before it stopped: at worst it verifies more than it had to.
        """
        n, need = len(self.vectors), threshold()
        norms = np.sqrt((queries**2).sum(axis=1))
        centre = (queries / norms[:, None]) @ self.lines
        windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def window(level: int) -> tuple[np.ndarray, np.ndarray]:
            if level not in windows:
                reach = RADII[level]
                ends = [(np.searchsorted(s, c - reach, "left"), np.searchsorted(s, c + reach, "right")) for s, c in zip(self.sorted, centre.T, strict=True)]
                windows[level] = tuple(np.stack(side, axis=1).astype(np.uint16) for side in zip(*ends, strict=True))
            return windows[level]

        out = []
        for q in range(len(queries)):
            barred = allowed(q)
            want = min(k, n - len(barred))
            done = np.zeros(n, bool)
            done[barred] = True
            ids, scores = np.zeros(0, np.int64), np.zeros(0)
            for level in range(self.start, len(RADII)):
                low, high = (side[q] for side in window(level))
                last = level == len(RADII) - 1
                # Too few collisions on all lines together for k vectors to reach the threshold.
                if not last and int(high.sum(dtype=np.int64)) - int(low.sum(dtype=np.int64)) < need * want:
                    continue
                enough = np.ones(n, bool) if last else self.collisions(low, high) >= need
                new = np.flatnonzero(enough & ~done)
                if len(new):
                    done[new] = True
                    least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf
                    new, exact = self.best_of(new, queries[q], k, least)
                    ids, scores = np.concatenate([ids, new]), np.concatenate([scores, exact])
                if len(ids) >= want:
                    kth = np.partition(scores, len(scores) - want)[len(scores) - want] if want else np.inf
                    # Squared distance of unit vectors: 2 - 2 cos.
                    if 2 - 2 * kth / (self.largest * norms[q]) <= RADII[level] ** 2:
                        break
            self.start = max(0, level - 1)
            out.append((ids, scores))
        return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector (doubles) of the rows that take part, each once."""
    v = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("vector")).filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(finite & F.exists("vector", lambda x: x != 0)).dropDuplicates(["id", "vector"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row for which ``is_query`` (on column id) holds."""
    rows = written(usable(vectors, id_column, vector_column), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, asked, largest = rows.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(norm)).first()
    blocks, groups = max(1, -(-n // BLOCK)), max(1, -(-asked // GROUP))
    block = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(groups)).cast("int")
    everywhere = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    data = rows.select(block.alias("block"), everywhere(groups).alias("group"), "id", "vector")
    queries = rows.filter(is_query).select(everywhere(blocks).alias("block"), group.alias("group"), "id", "vector")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for size in sorted(set(right["vector"].map(len))):
            here, asks = left[left["vector"].map(len) == size], right[right["vector"].map(len) == size]
            if not len(here):
                continue
            here = here.sort_values("id", kind="stable")
            ids, matrix = here["id"].to_numpy(), np.stack(here["vector"].to_numpy())
            names = pd.Series([v.tobytes() for v in matrix])
            kind = names.groupby(names, sort=False).cumcount().to_numpy()
            ids, matrix = ids[kind <= k], matrix[kind <= k]
            index = Index(matrix, largest)
            asks = asks.sort_values("id", kind="stable")
            ask_ids, ask = asks["id"].to_numpy(), np.stack(asks["vector"].to_numpy())
            for low in range(0, len(ask), 256):
                part = ask_ids[low : low + 256]
                got = index.search(ask[low : low + 256], lambda q, part=part: np.arange(np.searchsorted(ids, part[q]), np.searchsorted(ids, part[q], "right")), k)
                for q, (at, scores) in enumerate(got):
                    top = np.lexsort((ids[at], -scores))[:k]
                    found.append(pd.DataFrame({"query_id": part[q], "vec_id": ids[at[top]], "score": scores[top]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    met = data.groupBy("block", "group").cogroup(queries.groupBy("block", "group")).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
