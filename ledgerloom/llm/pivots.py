"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are drawn from the vectors, apart from each other. Every vector is described by a prefix
of its nearest pivots in order and stands in the inverted lists of the first of them. Vectors that meet in a list and
share at least SHARED pivots of their prefixes are linked by their cosine in double precision. The more pivots there
are, the less two near vectors agree on the nearest ones: how many lists a vector stands in is therefore measured on
pairs made at the threshold, and the prefix grows with it. Equal vectors collapse first, so a list grows with
different vectors only; long lists are dealt into block pairs, which keeps a task's work bounded and loses nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components, written

# The prefix for LISTS lists, and the least number of lists; lists_for and prefix_for give what is used.
PREFIX = 8
LISTS = 3
SHARED = 2
# Share of the pairs made at the threshold that must meet, and vectors that such pairs are made of.
WANTED = 0.99
TRIALS = 500
# Pivots for n different vectors: PIVOT_FACTOR times their root. The bounds keep the pivots' size on the driver.
PIVOT_FACTOR = 4
LEAST_PIVOTS = 32
MOST_PIVOTS = 4096
# Pivots are less alike than this (cosine). Several of them inside one tight group would be nearest to its members
# in an order that is chance, and members would miss each other.
SPACING = 0.7
# Vectors of a list that meet in a task at most, on either side.
BLOCK = 2048

_POINT = "vec_id bigint, size int, digest binary, point binary"


def points(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, size, digest, point): the vector's doubles as bytes; null for vectors that link with nothing."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, data = [], [], []
            for vec_id, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = None
                if vec_id is not None and own.is_valid and own.values.null_count == 0 and len(own.values):
                    value = own.values.to_numpy(zero_copy_only=False) + 0.0
                    scale = np.abs(value).max()
                    value = value if np.isfinite(scale) and scale > 0 else None
                raw = None if value is None else value.astype("<f8").tobytes()
                sizes.append(None if raw is None else len(value))
                digests.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
                data.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(data, pa.binary())], ["vec_id", "size", "digest", "point"])

    return vectors.select(F.col(id_col).cast("bigint").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(read, _POINT)


def _units(raw: list[bytes]) -> np.ndarray:
    """Vectors of one size as rows of length one; scaled first, so that squares neither vanish nor overflow."""
    rows = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def spaced(units: np.ndarray, number: int) -> np.ndarray:
    """The first ``number`` rows that are no more alike than SPACING to any row taken before."""
    taken = np.empty((0, units.shape[1]))
    for unit in units:
        if len(taken) == number:
            break
        if not len(taken) or (taken @ unit).max() < SPACING:
            taken = np.concatenate([taken, unit[None]])
    return taken


def nearest(units: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The nearest pivots of every vector, nearest first; ties go to the earlier pivot."""
    k = min(prefix, len(pivots))
    likeness = units @ pivots.T
    if k < len(pivots):
        # A stable choice: equal likeness counts in the order of the pivots.
        cut = np.partition(-likeness, k - 1, axis=1)[:, k - 1:k]
        likeness = np.where(-likeness <= cut, likeness, -np.inf)
    return np.argsort(-likeness, axis=1, kind="stable")[:, :k].astype(np.int32)


def prefix_for(lists: int) -> int:
    """Twice the lists and more, so that a pair that meets hardly ever fails to share SHARED pivots."""
    return PREFIX + 2 * (lists - LISTS)


def lists_for(units: np.ndarray, pivots: np.ndarray, threshold: float) -> int:
    """The least number of lists, LISTS at least, by which WANTED of the pairs at exactly the threshold meet.

    The pairs are made of the vectors that are no pivots: each is turned towards and away from another of them until
    their cosine is the threshold.
    """
    if len(pivots) <= LISTS or not len(units):
        return LISTS
    units = units[(units @ pivots.T).max(axis=1) < 1 - 1e-9][-TRIALS:]
    across = np.roll(units, 1, axis=0)
    across = across - (across * units).sum(axis=1, keepdims=True) * units
    long = np.linalg.norm(across, axis=1)
    units, across = units[long > 1e-6], across[long > 1e-6] / long[long > 1e-6, None]
    if not len(units):
        return LISTS
    cosine = min(1.0, max(-1.0, threshold))
    own = np.argsort(nearest(units, pivots, len(pivots)), axis=1)
    meet, share = [], []
    for sign in (1, -1):
        turned = cosine * units + sign * math.sqrt(1 - cosine * cosine) * across
        # The worse rank of a pivot in both orders: by the best pivot they meet, SHARED of them are shared.
        worse = np.maximum(own, np.argsort(nearest(turned, pivots, len(pivots)), axis=1))
        worse = np.partition(worse, SHARED - 1, axis=1)
        meet.append(worse[:, :SHARED].min(axis=1))
        share.append(worse[:, SHARED - 1])
    first, last = np.concatenate(meet), np.concatenate(share)
    for lists in range(LISTS, len(pivots)):
        if ((first < lists) & (last < prefix_for(lists))).mean() >= WANTED:
            return lists
    return len(pivots)


def _met(rows: list[tuple], threshold: float, lists: int) -> list[tuple[int, int | None, int]]:
    """(u, null, links of u met here) and (u, v, 0) for a forest of the links, for one block pair of one list.

    rows: (rep, copies, side, point, prefix). A pair is settled in the least list that both stand in.
    """
    rows.sort(key=lambda r: r[0])
    pivot = rows[0][5]
    units = _units([r[3] for r in rows])
    prefix = np.array([r[4] for r in rows], np.int32)
    side = np.array([r[2] for r in rows])
    copies = np.array([r[1] for r in rows], np.int64)
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0) if (side == 2).any() else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    near = units[left] @ units[right].T >= threshold
    if (side == 2).any():
        np.fill_diagonal(near, False)
    # Prefixes are compared for the vectors with a near one only; most have none in a list of different vectors.
    a, b = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(a):
        return []
    pivots = np.intersect1d(prefix[left[a]], prefix[right[b]])

    def held(of: np.ndarray, most: int) -> np.ndarray:
        own = prefix[of, :most]
        at = np.minimum(np.searchsorted(pivots, own), len(pivots) - 1)
        out = np.zeros((len(of), len(pivots)), np.float32)
        row, column = np.nonzero(pivots[at] == own)
        out[row, at[row, column]] = 1
        return out

    shared = held(left[a], prefix.shape[1]) @ held(right[b], prefix.shape[1]).T
    before = pivots < pivot
    earlier = held(left[a], lists)[:, before] @ held(right[b], lists)[:, before].T > 0
    linked = np.zeros_like(near)
    linked[np.ix_(a, b)] = near[np.ix_(a, b)] & (shared >= min(SHARED, prefix.shape[1])) & ~earlier
    if (side == 2).any():
        counts = linked @ copies[right]
        whole = linked
    else:
        counts = np.zeros(len(rows), np.int64)
        counts[left] = linked @ copies[right]
        counts[right] = linked.T @ copies[left]
        whole = np.zeros((len(rows), len(rows)), bool)
        whole[np.ix_(left, right)] = linked
        whole |= whole.T
    out = [(rows[k][0], None, int(counts[k])) for k in np.flatnonzero(counts).tolist()]
    unseen = whole.any(axis=1)
    while unseen.any():
        root = int(np.argmax(unseen))
        found = np.zeros(len(rows), bool)
        found[root] = True
        edge = found
        while edge.any():
            edge = whole[edge].any(axis=0) & ~found
            found |= edge
        out += [(rows[k][0], rows[root][0], 0) for k in np.flatnonzero(found).tolist() if k != root]
        unseen &= ~found
    return out


def near_vectors(vectors: DataFrame, folder: str, threshold: float = 0.9, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links (other vectors linked with it), component_id (smallest vec_id
    reachable by links), kept (it is that one itself).

    Vectors that are null, empty or zero, hold null or non-finite parts, or have no id link with nothing (the
    last have no component and are kept). Vectors of different sizes are not compared. Rows that repeat
    a vector are linked with each other. Tables in between are written below ``folder``.
    """
    spark = vectors.sparkSession
    every = written(points(vectors, id_col, vector_col), folder, "points")
    distinct = written(every.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"),
        F.first("point").alias("point")), folder, "distinct")
    # Few sizes are expected, and each draws its own pivots: rows of the driver are sizes, then pivots.
    counts = {row.size: row.n for row in distinct.groupBy("size").agg(F.count("*").alias("n")).collect()}
    pivots: dict[int, np.ndarray] = {}
    lists: dict[int, int] = {}
    for size, n in counts.items():
        number = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(PIVOT_FACTOR * math.sqrt(n))))
        drawn = (distinct.where(F.col("size") == size).orderBy(F.xxhash64("digest"), "digest").limit(2 * number + TRIALS)
                 .select("point").collect())
        units = _units([bytes(row.point) for row in drawn])
        pivots[size] = spaced(units[:2 * number], number)
        lists[size] = lists_for(units, pivots[size], threshold)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                for low in range(0, len(own), 1024):
                    part = batch.take(pa.array(own[low:low + 1024]))
                    prefix = nearest(_units(part.column(3).to_pylist()), pivots[size], prefix_for(lists[size]))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([lists[size]] * len(part), pa.int32()),
                         pa.array(list(prefix), pa.list_(pa.int32()))], [*part.schema.names, "lists", "prefix"])

    described = written(distinct.select("rep", "copies", "size", "point").mapInArrow(
        describe, "rep bigint, copies bigint, size int, point binary, lists int, prefix array<int>"), folder, "described")
    listed = described.select("*", F.explode(F.slice("prefix", 1, F.col("lists"))).alias("pivot"))
    lengths = (described.select("size", F.explode(F.slice("prefix", 1, F.col("lists"))).alias("pivot"))
               .groupBy("size", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
                                             F.count("*").alias("length")).where("length > 1"))
    blocked = listed.join(lengths, ["size", "pivot"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    spread = blocked.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "size", "pivot", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "rep", "copies",
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        "point", "lists", "prefix")

    def verify(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("rep", "copies", "side", "point", "prefix", "pivot")]
        found = _met(list(zip(*columns)), threshold, table.column("lists")[0].as_py())
        return pa.table([pa.array([r[k] for r in found], pa.int64()) for k in range(3)], names=["u", "v", "n"])

    met = written(spread.groupBy("size", "pivot", "a", "b").applyInArrow(verify, "u bigint, v bigint, n bigint"),
                  folder, "met")
    direct = met.where("v IS NULL").groupBy("u").agg(F.sum("n").alias("n"))
    linked = components(spark, met.where("v IS NOT NULL").select("u", "v"), folder)
    named = (distinct.select("digest", "rep", "copies")
             .join(direct, F.col("rep") == F.col("u"), "left").join(linked, F.col("rep") == F.col("node"), "left")
             .select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    joined = every.select("vec_id", "digest").join(named, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
