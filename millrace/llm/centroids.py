"""Clusters of integer vectors: Lloyd rounds whose nearest centroid is searched in Walsh-Hadamard coefficients.

The unscaled transform keeps squared distances but for the factor of its length, in whole
numbers. Squared differences of coefficients, added from the coarsest (fewest sign
changes) to the finest, only grow: a centroid whose part of the sum is over the whole sum of another one
is strictly worse and leaves. What remains is finished over all coefficients, so ties are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import batch
from millrace.session import stored

SCALE = 64
SMALL = 1 << 20  # components up to this size: sums of squared coefficient differences stay within 64 bits for 64 components
LIMB_BITS = 40
LONGEST = (1 << 63) - 1  # of a long

Vector = tuple[int, ...]


def coarse_to_fine(n: int) -> np.ndarray:
    """Rows of the Hadamard matrix of n (a power of two) by their number of sign changes."""
    h = np.ones((1, 1), dtype=np.int8)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def transformed(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, coarse first; whole numbers, scaled by nothing."""
    rows, n = x.shape
    h = 1
    while h < n:
        y = x.reshape(rows, n // (2 * h), 2, h)
        a, b = y[:, :, 0, :], y[:, :, 1, :]
        x = np.stack((a + b, a - b), axis=2).reshape(rows, n)
        h *= 2
    return x[:, order]


def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 * x) of each component; Python's integers if one is too large for the fast way."""
    if not values.size or np.abs(values).max() < SMALL // SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    each = [int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in values.ravel().tolist()]
    return np.array(each, dtype=object).reshape(values.shape)


class Search:
    """Nearest centroid of many vectors at once."""

    def __init__(self, centroids: list[Vector]):
        dim = len(centroids[0])
        large = max(abs(x) for c in centroids for x in c) > SMALL
        self.order = coarse_to_fine(dim)
        self.coefficients = transformed(np.array(centroids, dtype=object if large else np.int64), self.order)
        self.levels = [(0, 1)] + [(1 << i, 2 << i) for i in range(dim.bit_length() - 1)]
        self.dim = dim

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smaller one of a tie, and the squared distance."""
        n, k = len(x), len(self.coefficients)
        w, c = transformed(x, self.order), self.coefficients
        if w.dtype == object or c.dtype == object:
            w, c = w.astype(object), c.astype(object)
        part = np.zeros((n, k), dtype=w.dtype)
        first = min(4, self.dim)
        for j in range(k):
            part[:, j] = ((w[:, :first] - c[j, :first]) ** 2).sum(axis=1)
        # the one that looks nearest is finished at once: its sum is reached, so no larger one can win
        guess = part.argmin(axis=1)
        reached = ((w - c[guess]) ** 2).sum(axis=1)
        rows, cents = np.nonzero(part <= reached[:, None])
        sums = part[rows, cents]
        for lo, hi in self.levels:
            if hi <= first:
                continue
            sums = sums + ((w[rows, lo:hi] - c[cents, lo:hi]) ** 2).sum(axis=1)
            stay = sums <= reached[rows]
            rows, cents, sums = rows[stay], cents[stay], sums[stay]
        # rows and centroids are in ascending order: of equal sums the first is the smaller centroid
        by_sum = np.lexsort((cents, sums, rows)) if w.dtype != object else np.array(sorted(range(len(rows)), key=lambda i: (rows[i], sums[i], cents[i])), dtype=np.int64)
        best = by_sum[np.unique(rows[by_sum], return_index=True)[1]]
        return cents[best], sums[best] // self.dim


def _vectors(rows: pa.RecordBatch, dim: int) -> np.ndarray:
    return whole(rows.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def _limbs(total: int) -> list[int]:
    """``total`` in base 2 ** 40, the lowest first; the last one carries the sign."""
    out = []
    while not -(1 << 62) <= total < 1 << 62:
        out.append(total & ((1 << LIMB_BITS) - 1))
        total >>= LIMB_BITS
    return [*out, total]


_SUMS = "cluster int, component int, limb int, total long"
_SUMS_ARROW = pa.schema([("cluster", pa.int32()), ("component", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())])
MEMBERS = -1  # in place of a component: how many vectors


def _sums(dim: int, centroids: list[Vector]) -> Callable:
    """Component sums of each centroid's vectors; a task returns one set for each centroid, not its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        totals = np.zeros((len(centroids), dim), dtype=object)
        members = np.zeros(len(centroids), dtype=np.int64)
        for rows in batches:
            if not rows.num_rows:
                continue
            x = _vectors(rows, dim)
            cluster, _ = search.nearest(x)
            for j in np.unique(cluster):
                mine = x[cluster == j]
                totals[j] += mine.sum(axis=0).astype(object)
                members[j] += len(mine)
        out: list[list[int]] = [[], [], [], []]
        for j in np.flatnonzero(members).tolist():
            for component, total in [(MEMBERS, int(members[j])), *enumerate(map(int, totals[j]))]:
                for limb, value in enumerate(_limbs(total)):
                    for column, v in zip(out, (j, component, limb, value)):
                        column.append(v)
        yield batch(dict(zip(_SUMS_ARROW.names, out)), _SUMS_ARROW)

    return run


def _moved(kept: DataFrame, dim: int, centroids: list[Vector]) -> list[Vector]:
    """Componentwise floor of the mean of each centroid's vectors; one without vectors stays."""
    parts = kept.mapInArrow(_sums(dim, centroids), _SUMS)
    # a few rows for each centroid and component reach the driver, however many vectors there are
    sums = parts.groupBy("cluster", "component", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    whole_sums: dict[tuple[int, int], int] = {}
    for r in sums:
        key = (r.cluster, r.component)
        whole_sums[key] = whole_sums.get(key, 0) + (int(r.total) << LIMB_BITS * r.limb)
    out = list(centroids)
    for j in range(len(centroids)):
        if members := whole_sums.get((j, MEMBERS)):
            out[j] = tuple(whole_sums[j, i] // members for i in range(dim))
    return out


_ASSIGNED = "vec_id long, cluster int, distance long"
_ASSIGNED_ARROW = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _assigned(dim: int, centroids: list[Vector]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for rows in batches:
            if rows.num_rows:
                cluster, distance = search.nearest(_vectors(rows, dim))
                fits = [int(d) if d <= LONGEST else None for d in distance.tolist()]
                yield batch({"vec_id": rows.column("vec_id"), "cluster": cluster.astype(np.int32), "distance": fits}, _ASSIGNED_ARROW)

    return run


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    """vec_id and embedding of the vectors with exactly ``dim`` components, all finite."""
    each = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return each.where((F.size("embedding") == dim) & finite)


def starts(kept: DataFrame, dim: int, k: int, seed: str) -> list[Vector]:
    """The k vectors with the smallest sha256 of ``seed:vec_id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.withColumn("_key", key).orderBy(F.asc_nulls_last("_key"), "embedding").limit(k).collect()
    return [tuple(int(x) for x in v) for v in whole(np.array([r.embedding for r in first], dtype=np.float64).reshape(-1, dim))]


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, seed: str = "1") -> DataFrame:
    """Each vector's cluster after ``rounds`` Lloyd rounds over floor(64 * x), exactly.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored, whatever their names. ``dim`` is a
    power of two. Vectors that are null, of another length, or hold null or non-finite components are left out.
    Repeated rows count as often as they come and share their hash: the smaller embedding starts first. A null id starts last
    and stays null. With fewer than ``k`` vectors there are fewer clusters; an empty table gives no row.
    One row a vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256. A distance or
    sum that does not fit in 64 bits is null; assignments are exact for components of any size.

    Every pass reads the vectors once and returns k sets of sums for each task; only k centroids reach the driver.
    """
    spark = vectors.sparkSession
    kept = usable(vectors, dim)
    centroids = starts(kept, dim, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, dim, centroids)
    found = stored(kept.mapInArrow(_assigned(dim, centroids), _ASSIGNED), "clusters")
    sums = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"), F.count("*").alias("n"), F.count("distance").alias("known")
    ).collect()  # one row a cluster
    inertia = {r.cluster: int(r.inertia) if r.n == r.known else None for r in sums}
    total = None if None in inertia.values() else sum(inertia.values())

    def fits(value: int | None) -> int | None:
        return value if value is not None and value <= LONGEST else None

    table = [
        (j, fits(inertia[j]), fits(total), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for j, c in enumerate(centroids)
        if j in inertia
    ]
    facts = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
