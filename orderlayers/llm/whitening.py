"""Embedding whitening: principal components by contour integration of the covariance's resolvent.

Vectors become integers first, so their sums and, as long as they stay below 2 ** 53, the sums of
their centred products are exact whatever the order in which Spark adds them up. The covariance
(dimensions x dimensions, the only thing that comes to the driver) is then searched for its largest
eigenvalues: inertia counts of shifted matrices cut the spectrum into intervals of a few eigenvalues
each; for each interval, solves with the covariance shifted to the points of a quadrature around it
project a block of vectors onto the interval's invariant subspace; Rayleigh-Ritz extracts the
components from that; inertia counts say how many there must be, so none is missed.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite entries are dropped,
as are vectors of another length than most have (of equally frequent lengths, the greater counts).
Rows that repeat a vector, or a vec_id, get rows of their own each and count once in the fit; a NULL
``vec_id`` is a row like any other; other columns are not read. Components without variance
(relative to the trace, ``LEAST_SHARE``) do not exist, so equal vectors, or a single one, give no
rows, and neither does an empty table. ``deviation`` beyond 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import stored

#: Entries are multiplied by this, rounded down, and shifted.
SCALE, SHIFT = 64, 1_000_000
#: A component's least share of the trace.
LEAST_SHARE = 1e-13
#: Points of the quadrature on half of the circle around an interval; most eigenvalues an interval
#: should hold; rounds of projection.
POINTS, CROWD, ROUNDS = 12, 6, 40
#: Where an interval may be cut, as shares of its width.
CUTS = (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9)


def _pivots(matrix: np.ndarray) -> tuple[int, int]:
    """Numbers of positive and negative eigenvalues, by block elimination with complete pivoting."""
    a = matrix.copy()
    positive = negative = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        k = int(diagonal.argmax())
        rest = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(rest.argmax()), rest.shape)
        if max(diagonal[k], rest[i, j]) == 0:
            break
        if diagonal[k] >= 0.64 * rest[i, j]:
            block = np.array([k])
            positive, negative = positive + (a[k, k] > 0), negative + (a[k, k] < 0)
        else:
            # No diagonal entry outweighs this one, so its block has one eigenvalue of each sign.
            block = np.array([i, j])
            positive, negative = positive + 1, negative + 1
        others = np.setdiff1d(np.arange(len(a)), block)
        across = a[np.ix_(others, block)]
        a = a[np.ix_(others, others)] - across @ np.linalg.solve(a[np.ix_(block, block)], across.T)
        a = (a + a.T) / 2
    return int(positive), int(negative)


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``, by the inertia of the shifted matrix."""
    return _pivots(matrix - shift * np.eye(len(matrix)))[0]


def _is_clear(matrix: np.ndarray, cut: float, margin: float) -> bool:
    return count_above(matrix, cut - margin) == count_above(matrix, cut + margin)


def _intervals(matrix: np.ndarray, low: float, high: float, above_low: int, above_high: int, least: float):
    """(low, high, count) from the top down; crowded ones are cut where no eigenvalue is near."""
    inside = above_low - above_high
    if not inside:
        return
    width = high - low
    cuts = [low + part * width for part in CUTS] if inside > CROWD and width > least else []
    cut = next((c for c in cuts if _is_clear(matrix, c, 0.02 * width)), None)
    if cut is None:
        yield low, high, inside
        return
    above = count_above(matrix, cut)
    yield from _intervals(matrix, cut, high, above, above_high, least)
    yield from _intervals(matrix, low, cut, above_low, above, least)


def _project(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues within an interval, falling, and their unit eigenvectors."""
    size = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (nodes + 1)
    scale = max(np.abs(matrix).max() * size, np.finfo(float).tiny)
    centre = (low + high) / 2
    radius = max((high - low) / 2, 1e-9 * np.abs(matrix).max()) * 1.01
    block = np.random.default_rng(12).standard_normal((size, min(size, count + CROWD)))
    best = None
    for _ in range(ROUNDS):
        found = np.zeros_like(block)
        for angle, weight in zip(angles, weights):
            # The lower half of the circle is the conjugate of the upper one.
            turn = radius * np.exp(1j * angle)
            solved = np.linalg.solve((centre + turn) * np.eye(size) - matrix, block.astype(complex))
            found += weight / 2 * (turn * solved).real
        basis, _ = np.linalg.qr(found)
        small = basis.T @ matrix @ basis
        values, inner = np.linalg.eigh((small + small.T) / 2)
        vectors = basis @ inner
        nearest = np.argsort(np.abs(values - centre), kind="stable")[:count]
        nearest = nearest[np.argsort(-values[nearest], kind="stable")]
        error = np.abs(matrix @ vectors[:, nearest] - vectors[:, nearest] * values[nearest]).max()
        if best is None or error < best[0]:
            best = error, values[nearest], vectors[:, nearest]
        elif best[0] <= 1e-12 * scale:
            break
        block = vectors
    if best[0] > 1e-9 * scale:
        raise ArithmeticError("the projection onto an eigenvalue interval does not converge")
    return best[1], best[2]


def largest_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a positive semidefinite matrix, and their eigenvectors.

    Eigenvalues without a share of the trace are left out, so there may be fewer.
    """
    size, trace = len(matrix), float(np.trace(matrix))
    if not size or trace <= 0:
        return np.empty(0), np.empty((size, 0))
    high = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)
    floor = LEAST_SHARE * trace
    wanted = min(count, count_above(matrix, floor))
    # The smallest shift found that leaves at least the wanted number above it.
    low, top = floor, high
    for _ in range(60):
        middle = (low + top) / 2
        above = count_above(matrix, middle)
        if above >= wanted:
            low = middle
        else:
            top = middle
        if above == wanted or top - low <= 1e-12 * high:
            break
    # Eigenvalues close below it belong to the same crowd and are projected with it.
    width = high - low
    while low > floor and not _is_clear(matrix, low - 1e-4 * width, 1e-4 * width):
        low = max(low - 2e-4 * width, floor)
    above_low = count_above(matrix, low)
    values, vectors = [], []
    for a, b, inside in _intervals(matrix, low, high, above_low, 0, 1e-6 * high):
        found, columns = _project(matrix, a, b, inside)
        values.append(found)
        vectors.append(columns)
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    # Intervals were projected one by one: what is left of one in another is taken out.
    vectors, turned = np.linalg.qr(vectors)
    vectors = vectors * np.where(np.diag(turned) < 0, -1, 1)
    if len(values) != above_low or np.abs(matrix @ vectors - vectors * values).max() > 1e-9 * high:
        raise ArithmeticError("components are missing")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: everything is as large as a few vectors."""

    n: int
    #: Each dimension's sum is ``n * base + rest``, 0 <= rest < n.
    base: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of integer vectors."""
        centred = (x - self.base).astype(np.float64) - self.rest / self.n
        return (centred @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Exact sum over dimensions of (n * x - S) ** 2."""
        y = x - self.base
        largest = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if largest * largest * x.shape[1] < 1 << 63:
            return ((y * self.n - self.rest) ** 2).sum(axis=1)
        exact = ((y.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return np.array([int(v) for v in exact], np.int64)


def _rows(column: pa.Array, size: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def integer_vectors(frame: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the rows of ``frame`` (vec_id, embedding) that have a vector."""
    entries = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        frame.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter((F.size("embedding") > 0) & usable)
        .select("vec_id", F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))
    )


def _summed(fit: DataFrame, size: int, cells: int, of_block) -> np.ndarray:
    """Sum over all rows of ``of_block(x)``, an array of ``cells`` entries, added up in Spark.

    A task sends one row a cell, so what is shuffled does not grow with the rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = of_block(_rows(batch.column(0), size))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(cells)), pa.array(total.reshape(-1))], ["cell", "part"]
            )

    kind = "long" if of_block(np.zeros((0, size), np.int64)).dtype == np.int64 else "double"
    summed = fit.select("x").mapInArrow(work, f"cell long, part {kind}").groupBy("cell").agg(F.sum("part").alias("part"))
    found = summed.toArrow()
    out = np.zeros(cells, np.int64 if kind == "long" else np.float64)
    out[found["cell"].to_numpy()] = found["part"].to_numpy()
    return out


def fit_whitening(vectors: DataFrame, size: int, components: int) -> tuple[Whitening, float] | None:
    """The whitening of the distinct ``x`` of ``vectors``, and its largest error on them.

    The error is that of the whitened rows' covariance, added up over all of them, to the identity.
    None where there is no vector.
    """
    fit = stored(vectors.select("x").distinct(), "whitening-fit")
    n = fit.count()
    if n == 0:
        return None
    sums = _summed(fit, size, size, lambda x: x.sum(axis=0, dtype=np.int64))
    base = sums // n
    rest = sums - n * base

    def products(x: np.ndarray) -> np.ndarray:
        y = (x - base).astype(np.float64)
        return y.T @ y

    shift = rest / n
    covariance = _summed(fit, size, size * size, products).reshape(size, size) / n - np.outer(shift, shift)
    covariance = (covariance + covariance.T) / 2
    values, columns = largest_components(covariance, components)
    model = Whitening(n, base, rest, values, columns, float(np.trace(covariance)))
    kept = len(values)
    if not kept:
        return model, 0.0

    def spread(x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        return np.concatenate([(w.T @ w).reshape(-1), w.sum(axis=0)])

    found = _summed(fit, size, kept * kept + kept, spread) / n
    means = found[kept * kept :]
    error = np.abs(found[: kept * kept].reshape(kept, kept) - np.outer(means, means) - np.eye(kept)).max()
    return model, float(error)


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten_embeddings(frame: DataFrame, components: int = 16) -> DataFrame:
    """A row for each vector of ``frame`` (vec_id, embedding) and each of the largest components."""
    vectors = stored(integer_vectors(frame), "whitening-vectors")
    lengths = vectors.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("k"))
    size = lengths.agg(F.max(F.struct("k", "size")).alias("top")).first()["top"]
    spark = frame.sparkSession
    if size is None:
        return spark.createDataFrame([], SCHEMA)
    size = size["size"]
    vectors = vectors.filter(F.size("x") == size)
    model, error = fit_whitening(vectors, size, components)
    kept = len(model.values)
    shared = spark.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whitening = shared.value
        explained = whitening.values / whitening.trace
        for batch in batches:
            if not kept:
                continue
            x = _rows(batch.column(1), size)
            rows = len(x)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows), kept)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * kept, whitening.n, np.int64)),
                    pa.array(np.repeat(whitening.deviation(x), kept)),
                    pa.array(whitening.project(x).reshape(-1)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * kept, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(work, SCHEMA)
