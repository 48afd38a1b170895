"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Each component c of a vector becomes the whole number ``floor(256 * c)``. The *fit list*
holds each distinct vector of whole numbers once, so copies weigh nothing.

1. One aggregate counts the fit list and sums every dimension (exactly, as decimals).
2. Every task adds up the products of its centred vectors, ``d`` rows of ``d`` numbers;
   an aggregate adds the tasks. Only that d x d scatter reaches the driver.
3. Pivoted Cholesky turns the scatter into ``L L'``, largest remaining diagonal first, and
   stops at its rank. One-sided Jacobi rotates the columns of L until they are orthogonal:
   their squared norms are the eigenvalues, the columns over their norms the components.
   Rounds of disjoint pairs are rotated together.
4. Rows are projected where they lie; another aggregate over the fit list checks that the
   whitened components have the identity as their covariance.

Vectors that are null, empty, or hold null or non-finite entries take no part. Of vectors
of several lengths only the most frequent length takes part (of equally frequent ones the
longest). Whole numbers beyond 64 bits are held at their ends. Components whose eigenvalue
is zero but for rounding have no rows, so equal vectors alone give an empty result, as does
an empty table. A deviation beyond 64 bits is null. Rows with equal or null ids are
separate rows; extra columns are left aside.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forespell.llm.components import written

#: Whole numbers per unit of a component.
SCALE = 256
#: Rotations are skipped when the cosine of two columns is below this.
ORTHOGONAL = 1e-15
SWEEPS = 60


class Model(NamedTuple):
    """Components of the fit list, by falling eigenvalue (columns of ``components``)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (d x rank, lower triangular in its first rows) and the pivots: ``scatter[p][:, p] = L L'``."""
    work, size = scatter.astype(float).copy(), len(scatter)
    pivots = np.arange(size)
    factor = np.zeros((size, size))
    floor = size * np.finfo(float).eps * max(work.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        top = k + int(np.argmax(work.diagonal()[k:]))
        if not work[top, top] > floor:
            return factor[:, :k], pivots
        for swapped in (work, work.T, factor):
            swapped[[k, top]] = swapped[[top, k]]
        pivots[[k, top]] = pivots[[top, k]]
        factor[k, k] = np.sqrt(work[k, k])
        factor[k + 1 :, k] = work[k + 1 :, k] / factor[k, k]
        work[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, pivots


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated among themselves until each two are orthogonal."""
    columns = factor.T.copy()
    count = len(columns)
    seats = np.arange(count + count % 2)
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            left, right = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            real = (left < count) & (right < count)
            turned |= _rotate(columns, left[real], right[real])
            seats[1:] = np.roll(seats[1:], 1)  # every two meet once in a sweep
        if not turned:
            break
    return columns.T


def _rotate(columns: np.ndarray, left: np.ndarray, right: np.ndarray) -> bool:
    """Make the pairs of columns orthogonal; whether any was turned."""
    a, b = columns[left], columns[right]
    alpha, beta, gamma = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
    apart = np.abs(gamma) > ORTHOGONAL * np.sqrt(alpha * beta)
    if not apart.any():
        return False
    left, right, a, b = left[apart], right[apart], a[apart], b[apart]
    zeta = (beta[apart] - alpha[apart]) / (2 * gamma[apart])
    tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
    cos = (1 / np.hypot(1.0, tangent))[:, None]
    sin = cos * tangent[:, None]
    columns[left], columns[right] = cos * a - sin * b, sin * a + cos * b
    return True


def eigenpairs(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and unit eigenvectors (columns; the largest entry of each is positive)."""
    factor, pivots = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    values = (turned**2).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > len(scatter) * np.finfo(float).eps * values.max(initial=0.0)]
    vectors = np.zeros((len(scatter), len(order)))
    vectors[pivots] = turned[:, order] / np.sqrt(values[order])
    if len(order):
        vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors


def whole(vector: Column) -> Column:
    """The vector as whole numbers, or null if it takes no part."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(vector.isNotNull() & finite & (F.size(entries) > 0), F.transform(entries, lambda c: F.floor(c * SCALE)))


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, x: the rows that take part."""
    rows = vectors.select(F.col(id_column).alias("vec_id"), whole(F.col(vector_column)).alias("x")).filter("x is not null")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.filter(F.size("x") == (lengths["length"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0), np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n: the whole part of the mean is taken away exactly, the rest in double precision."""
    mean = [s // n for s in sums]
    rest = np.array([(s - m * n) / n for s, m in zip(sums, mean, strict=True)])
    spread = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0) + max(map(abs, mean), default=0)
    if spread < 1 << 62:
        return (x - np.array(mean, np.int64)).astype(float) - rest
    return (x.astype(object) - np.array(mean, object)).astype(float) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - sums) squared, exactly; null beyond 64 bits."""
    if not len(x):
        return []
    reach = max(abs(int(x.min())), abs(int(x.max()))) * n + max(map(abs, sums))
    if reach**2 * x.shape[1] < 1 << 63:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def _added(fit: DataFrame, rows_of) -> np.ndarray:
    """Sum over the tasks of the matrix that ``rows_of`` makes of the vectors of a batch."""

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = rows_of(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch({"i": pa.array(np.arange(len(total)), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64()))})

    parts = fit.select("x").mapInArrow(partial, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d x d numbers, however many vectors
    size = max((c["i"] for c in cells), default=-1) + 1
    out = np.zeros((size, size))
    for c in cells:
        out[c["i"], c["j"]] = c["v"]
    return out


def fit(rows: DataFrame) -> tuple[Model, DataFrame]:
    """The components of the distinct vectors ``x`` of ``rows``, and those vectors."""
    distinct = written(rows.select("x").distinct(), "fit-list")
    n = distinct.count()
    summed = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i")
    sums = [int(r["s"]) for r in summed.collect()]  # one row per dimension

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums)
        return y.T @ y

    scatter = _added(distinct, products)
    values, vectors = eigenpairs(scatter)
    return Model(n, sums, values / max(n, 1), vectors, float(scatter.trace()) / max(n, 1)), distinct


def whitened(x: np.ndarray, model: Model, k: int) -> np.ndarray:
    """Centred vectors on the first ``k`` components, over the root of their eigenvalues."""
    return (centred(x, model.n, model.sums) @ model.components[:, :k]) / np.sqrt(model.eigenvalues[:k])


def identity_error(model: Model, distinct: DataFrame, k: int) -> float:
    """Largest entry of (covariance of the whitened fit list - identity)."""

    def products(x: np.ndarray) -> np.ndarray:
        z = np.hstack([whitened(x, model, k), np.ones((len(x), 1))])
        return z.T @ z

    added = _added(distinct, products) / model.n
    mean = added[:-1, -1]
    return float(np.abs(added[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max(initial=0.0))


def whiten(vectors: DataFrame, k: int = 4, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: rows times up to ``k`` components."""
    rows = usable(vectors, id_column, vector_column)
    model, distinct = fit(rows)
    k = min(k, len(model.eigenvalues))
    error = identity_error(model, distinct, k) if k else 0.0
    explained = model.eigenvalues[:k] / model.trace if k else np.zeros(0)

    def project(batches):
        for batch in batches:
            x, ids = _matrix(batch.column("x")), batch.column("vec_id")
            if not (k and len(x)):
                continue
            each = np.repeat(np.arange(len(x)), k)
            yield pa.record_batch(
                {
                    "vec_id": ids.take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(each), model.n, np.int64)),
                    "deviation": pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)),
                    "whitened": pa.array(whitened(x, model, k).ravel()),
                    "explained": pa.array(np.tile(explained, len(x))),
                    "identity_error": pa.array(np.full(len(each), error)),
                }
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(project, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
