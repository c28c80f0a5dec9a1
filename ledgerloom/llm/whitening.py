"""Whitening of vectors: distributed covariance, eigenvectors refined from single to double precision.

Vectors become whole numbers, and each distinct one is fitted once. Spark sums the columns exactly, then the
products of the centred vectors, one partial matrix for each task, summed by entry. The matrix, whose size is that of
a vector and not of the table, is solved on the driver: eigenvectors in float32, then corrected in float64 by
Ogita-Aishima steps, which need matrix products only and double the correct digits each time. Where eigenvalues lie
too close for the division in a step, the vectors of such a cluster are made orthogonal and a small problem, shifted
by the cluster's mean, turns them into place; the steps go on from there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Whole numbers beyond this do not keep their unit as doubles; a vector with such an entry counts as broken.
MOST_ENTRY = 1 << 52
# Sums are kept in two parts of this many bits, so that each stays a long for 2**36 rows.
PART_BITS = 26
MOST_STEPS = 40

OUT_SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")


def _whole(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable, size, entries as whole numbers of all usable vectors one after the other)."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())
    empty = flat.is_null().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, 0.0).to_numpy(zero_copy_only=False)
    broken = empty | ~(np.abs(values) < MOST_ENTRY / SCALE)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    usable[owner[broken]] = False
    kept = values[usable[owner]] if len(owner) else values
    return usable, sizes, np.floor(SCALE * kept).astype(np.int64) + SHIFT


def _column(vectors: DataFrame, vector_col: str):
    return F.col(vector_col).cast("array<double>").alias("vector")


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """(size, x) of every distinct whole-number vector, x as little-endian longs."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, sizes, flat = _whole(batch.column(0))
            sizes = sizes[usable]
            ends = np.cumsum(sizes) * 8
            data = flat.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()),
                 pa.array([data[end - 8 * size:end] for size, end in zip(sizes.tolist(), ends.tolist())], pa.binary())],
                ["size", "x"])

    return vectors.select(_column(vectors, vector_col)).mapInArrow(convert, "size int, x binary").distinct()


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), -1)


def _triangle(matrix: np.ndarray, names: list[str]) -> pa.RecordBatch:
    i, j = np.triu_indices(len(matrix))
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix[i, j])], names)


def _square(rows: pa.Table, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    i, j, v = (rows.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


def column_sums(fitted: DataFrame, size: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum of each column); no more rows reach the driver than a vector has entries."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, parts = 0, np.zeros((2, size), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0)) if batch.num_rows else np.empty((0, size), np.int64)
            n += len(x)
            parts += [(x >> PART_BITS).sum(axis=0), (x & ((1 << PART_BITS) - 1)).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                                          pa.array(parts[0]), pa.array(parts[1])], ["i", "n", "high", "low"])

    rows = (fitted.select("x").mapInArrow(add, "i int, n bigint, high bigint, low bigint").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect())
    return (rows[0].n if rows else 0), [(r.high << PART_BITS) + r.low for r in rows]


@dataclass
class Centre:
    """The means of the columns as whole numbers and the fractions left, so that differences keep all digits."""
    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n / self.n for s in self.sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - sum)^2 over the columns, exact; null where a long cannot hold it."""
        about = self.n * np.abs(self(x)).max(axis=1, initial=0.0)
        if len(x) and about.max() ** 2 * x.shape[1] < 2.0 ** 62:
            # n x - sum = n (x - whole) - rest, all parts small.
            d = self.n * (x - self.whole) - np.array([s % self.n for s in self.sums], np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def covariance(fitted: DataFrame, size: int, centre: Centre, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the vectors, or of their projections (columns of ``project``), divisor n.

    A task sums the products of its own vectors; the partial matrices are added by entry in Spark, and no more than one
    matrix reaches the driver.
    """
    width = size if project is None else project.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                x = centre(_matrix(batch.column(0)))
                x = x if project is None else x @ project
                total += x.T @ x
                found = True
        if found:
            yield _triangle(total, ["i", "j", "v"])

    rows = fitted.select("x").mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    return _square(rows.toArrow(), width) / centre.n


def refine(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima step in double precision: (better vectors, eigenvalues, size of the correction).

    Pairs of eigenvalues closer than the step can tell apart only have their vectors made orthogonal.
    """
    r = np.eye(len(matrix)) - vectors.T @ vectors
    s = vectors.T @ matrix @ vectors
    # Equal halves: what rounding makes of s turns the vectors, but never against each other.
    s = (s + s.T) / 2.0
    values = np.diag(s) / (1.0 - np.diag(r))
    close = _resolution(matrix, s, r, values)
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    step = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2.0)
    return vectors + vectors @ step, values, float(np.abs(step).max(initial=0.0))


def _resolution(matrix: np.ndarray, s: np.ndarray, r: np.ndarray, values: np.ndarray) -> float:
    off = s - np.diag(values)
    return 2.0 * (np.linalg.norm(off, 2) + np.linalg.norm(matrix, 2) * np.linalg.norm(r, 2))


def _clusters(values: np.ndarray, close: float) -> list[np.ndarray]:
    """Places of the eigenvalues, rising, that lie within ``close`` of a neighbour; those alone are left out."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > close) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def eigenpairs(matrix: np.ndarray, steps: int = MOST_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, their unit eigenvectors as columns) of a symmetric matrix, to double precision.

    The start is in float32. Each round turns the vectors of clustered eigenvalues within their cluster and then takes
    a refining step; it ends when steps no longer become smaller. Vectors point so that their largest entry is positive.
    """
    if not len(matrix):
        return np.empty(0), np.empty((0, 0))
    size = float(np.abs(matrix).max())
    if not size:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scaled = matrix / size
    vectors = np.linalg.eigh(scaled.astype(np.float32))[1].astype(np.float64)
    last = np.inf
    for _ in range(steps):
        s, r = vectors.T @ scaled @ vectors, np.eye(len(matrix)) - vectors.T @ vectors
        values = np.diag(s) / (1.0 - np.diag(r))
        for own in _clusters(values, _resolution(scaled, s, r, values)):
            # The eigenvectors of the small problem turn the cluster's vectors; its mean is taken off first.
            basis = np.linalg.qr(vectors[:, own])[0]
            mean = float(values[own].mean())
            small = basis.T @ (scaled @ basis - mean * basis)
            vectors[:, own] = basis @ np.linalg.eigh((small + small.T) / 2.0)[1]
        vectors, values, correction = refine(scaled, vectors)
        if correction > last / 2.0 and last < 1e-3:
            break
        last = correction
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, scaled @ vectors) * size
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    turned = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * turned


def whiten(vectors: DataFrame, folder: str, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1, by falling eigenvalue), n (distinct
    whole-number vectors), deviation, whitened, explained (share of the total variance), identity_error (largest entry by
    which the covariance of what is whitened differs from the identity).

    An entry c becomes x = floor(64 c) + 1000000. Vectors that are null, empty or hold null, non-finite or huge (2**46 on)
    entries give no rows. The size that most distinct vectors have (of several, the smaller) is fitted; a vector of another
    size gets one row in which only vec_id is set. Components whose eigenvalue is rounding noise are left out, so
    a table whose vectors are all alike has no component; its vectors get such a row too. Repeated and null ids stay
    as they are. ``deviation`` is null where a long cannot hold it.
    The driver holds matrices of a vector's size squared. The fit list is written below ``folder``.
    """
    spark = vectors.sparkSession
    fitted = written(fit_list(vectors, vector_col), folder, "fit")
    sizes = fitted.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], OUT_SCHEMA)
    size = sizes[0]["size"]
    own = fitted.where(F.col("size") == size)
    centre = Centre(*column_sums(own, size))
    matrix = covariance(own, size, centre)
    values, axes = eigenpairs(matrix)
    total = float(np.trace(matrix))
    noise = size * np.finfo(np.float64).eps * max(float(values[0]), 0.0)
    count = min(components, int((values > noise).sum()))
    project = axes[:, :count] / np.sqrt(values[:count])
    explained = values[:count] / total if count else np.empty(0)
    error = float(np.abs(covariance(own, size, centre, project) - np.eye(count)).max()) if count else 0.0

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                usable, lengths, flat = _whole(part.column(1))
                ids = part.column(0).filter(pa.array(usable))
                lengths = lengths[usable]
                fits = (lengths == size) & (count > 0)
                x = flat[np.repeat(fits, lengths)].reshape(-1, size)
                yield _rows(ids.filter(pa.array(fits)), x)
                yield _bare(ids.filter(pa.array(~fits)))

    def _rows(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        n = len(x)
        each = np.repeat(np.arange(n), count)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), n), pa.int32()),
             pa.array(np.full(n * count, centre.n), pa.int64()),
             pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
             pa.array((centre(x) @ project).reshape(-1), pa.float64()), pa.array(np.tile(explained, n), pa.float64()),
             pa.array(np.full(n * count, error), pa.float64())], names)

    def _bare(ids: pa.Array) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([ids, *[pa.nulls(len(ids), kind) for kind in kinds]], names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), _column(vectors, vector_col)).mapInArrow(
        apply, OUT_SCHEMA)
