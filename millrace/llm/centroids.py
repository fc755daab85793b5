"""Centroid clustering: bounds of a simplex projection leave centroids out before whole-number distances are compared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import plain, written

SCALE, WIDTH = 256.0, 64
CENTROIDS, ROUNDS = 40, 5
# Vectors that pivots are chosen from (those with the smallest hashes), and pivots.
FIT_ROWS, PIVOTS = 1024, 16
# Larger whole numbers could give distances beyond 64 bits, and fail.
LARGEST = 1 << 27
# Rows whose vectors are compared at a time.
STEP_ROWS = 4096


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, width: int = WIDTH) -> DataFrame:
    """(id, v) of the vectors with exactly ``width`` components, none NULL or non-finite: floor(SCALE * x), 32 bits each."""
    vector = plain(vector_column).cast("array<double>")
    usable = vector.isNotNull() & (F.size(vector) == width) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(SCALE * batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError("a component is too large for distances of 64 bits")
            packed = pa.array([row.tobytes() for row in x.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed], ["id", "v"])

    kept = vectors.filter(usable).select(plain(id_column).cast("long").alias("id"), vector.alias("x"))
    return kept.mapInArrow(run, "id bigint, v binary")


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of packed numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of whole-number rows of ``a`` to those of ``b``, exact."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4 * int(largest) ** 2 * a.shape[1] < 2**53:  # products are exact in floating point too
        inner = (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * inner
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1).reshape(len(a), len(b))


class Simplex:
    """Pivots as corners of a simplex; a point is the apex over them that its distances to the pivots fix.

    The apex has one coordinate per pivot: its place in the space of the pivots, and last its height over it. For two
    points, the distance of their apexes is a lower bound of their distance, and with the heights added instead of
    subtracted it is an upper bound.
    """

    def __init__(self, pivots: np.ndarray):
        chosen, base = [], np.zeros((0, 0))
        for pivot in pivots:
            if not chosen:
                chosen = [pivot]
                continue
            apex = self._apex(base, squared(pivot[None], np.stack(chosen)))[0]
            if apex[-1] ** 2 > 1e-9 * (1 + (apex**2).sum()):  # else it lies among the others
                base = np.block([[base, np.zeros((len(base), 1))], [apex[None]]])
                chosen.append(pivot)
        self.base, self.pivots = base, np.stack(chosen) if chosen else np.zeros((0, WIDTH), np.int64)

    @staticmethod
    def _apex(base: np.ndarray, distances: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots; the first pivot is the origin, ``base`` are the others."""
        to_first = distances[:, 0].astype(np.float64)
        right = ((base**2).sum(axis=1) + (to_first[:, None] - distances[:, 1:])) / 2
        place = np.linalg.solve(base, right.T).T if len(base) else np.zeros((len(distances), 0))
        height = np.sqrt(np.maximum(to_first - (place**2).sum(axis=1), 0.0))
        return np.concatenate([place, height[:, None]], axis=1)

    @property
    def width(self) -> int:
        return len(self.pivots)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        return self._apex(self.base, squared(vectors, self.pivots))


def bounds(apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances, widened by what rounding may have taken."""
    norms_a, norms_c = (apexes**2).sum(axis=1), (centroids**2).sum(axis=1)
    low = norms_a[:, None] + norms_c[None, :] - 2 * (apexes @ centroids.T)
    high = low + 4 * apexes[:, -1:] * centroids[None, :, -1]
    slack = 1e-7 * (1 + norms_a[:, None] + norms_c[None, :])
    return low - slack, high + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, of_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (the smaller number of equal ones), its squared distance, and distances computed."""
    low, high = bounds(apexes, of_centroids)
    row, centroid = np.nonzero(low <= high.min(axis=1)[:, None])
    distances = np.empty(len(row), dtype=np.int64)
    order = np.argsort(centroid, kind="stable")
    for begin, end in zip(*(np.searchsorted(centroid[order], np.arange(len(centroids)), side) for side in ("left", "right"))):
        some = order[begin:end]
        if len(some):
            distances[some] = squared(vectors[row[some]], centroids[centroid[some[0]]][None])[:, 0]
    starts = np.searchsorted(row, np.arange(len(vectors)))
    least = np.minimum.reduceat(distances, starts) if len(vectors) else distances
    is_least = np.flatnonzero(distances == np.repeat(least, np.diff(np.append(starts, len(row)))))
    first = is_least[np.concatenate([[True], row[is_least[1:]] != row[is_least[:-1]]])] if len(is_least) else is_least
    return centroid[first], least, len(row)


def _start_order(id_column: str, vector_column: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")), 256)
    return [digest.asc_nulls_last(), F.col(vector_column)]


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", centroids: int = CENTROIDS,
    rounds: int = ROUNDS, width: int = WIDTH, pivots: int = PIVOTS, seed: int = 2,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Vectors of exactly ``width`` finite components take part, as whole numbers. The first centroids are the vectors with the
    smallest SHA-256 of ``seed:id``; each round assigns every vector to the nearest centroid (squared distance, the smaller
    number of equal ones) and moves each centroid with vectors to the floor of their mean. Then vectors are assigned
    once more.

    Distances to ``pivots`` vectors are computed once and kept as apex coordinates; a round compares them with those of
    the centroids and leaves out every centroid whose lower bound is above the least upper bound. What remains is decided
    by exact distances. A round reads the kept table and returns one row per cluster and task; only the centroids come to
    the driver. No row is shuffled, so equal vectors, however many, are work for all tasks.

    Vectors that are NULL, of another length, or hold a NULL or non-finite component are left out. Repeated rows are vectors
    of their own; a NULL id comes last among the starting points, and equal ids start in the order of their vectors. Fewer
    vectors than centroids: as many centroids as vectors. Components beyond 2^27 fail. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    whole = written(whole_vectors(vectors, id_column, vector_column, width), "centroids-vectors")
    first = whole.orderBy(*_start_order("id", "v", seed)).limit(max(centroids, FIT_ROWS)).select("v").toArrow().column(0)
    sample = _matrix(first, "<i4", width).astype(np.int64)
    result = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(sample):
        return spark.createDataFrame([], f"id bigint, {result}").withColumnRenamed("id", id_column)
    centres = sample[:centroids]
    simplex = Simplex(far_apart(sample[:FIT_ROWS], pivots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = simplex.apexes(_matrix(batch.column("v"), "<i4", width))
                apexes = pa.array([row.tobytes() for row in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, apexes], ["id", "v", "apex"])

    index = written(whole.mapInArrow(place, "id bigint, v binary, apex binary"), "centroids-apexes")

    def assigned(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[tuple]:
        of_centres = simplex.apexes(centres)
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(begin, STEP_ROWS)
                v, apexes = _matrix(part.column("v"), "<i4", width), _matrix(part.column("apex"), "<f8", simplex.width)
                yield part, v, *nearest(v, apexes, centres, of_centres)[:2]

    for _ in range(rounds):
        centres = _moved(index, centres, assigned)
    last = centres

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster_, distance in assigned(batches, last):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(cluster_.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
            )

    answer = written(index.mapInArrow(final, "id bigint, cluster int, distance bigint"), "centroids-answer")
    inertia = answer.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    total = sum(int(r["sum"]) for r in inertia)
    names = {c: hashlib.sha256(",".join(map(str, last[c].tolist())).encode()).hexdigest() for c in range(len(last))}
    rows = [(r["cluster"], int(r["sum"]), total, names[r["cluster"]]) for r in inertia]
    # one row per centroid
    sums = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return answer.join(F.broadcast(sums), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it."""
    chosen, near = [0], squared(sample, sample[:1])[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _moved(index: DataFrame, centres: np.ndarray, assigned) -> np.ndarray:
    """Centroids at the floor of the mean of their vectors; those without vectors stay."""
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(centres), width), dtype=object), np.zeros(len(centres), np.int64)
        for _, v, cluster_, _ in assigned(batches, centres):
            order = np.argsort(cluster_, kind="stable")
            some, starts = np.unique(cluster_[order], return_index=True)
            if len(some):
                sums[some] += np.add.reduceat(v[order].astype(np.int64), starts, axis=0)
                counts[some] += np.diff(np.append(starts, len(order)))
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array([[str(x) for x in sums[c]] for c in some], pa.list_(pa.string()))],
                ["cluster", "n", "sums"],
            )

    parts = index.select("id", "v", "apex").mapInArrow(run, "cluster int, n bigint, sums array<string>")
    by_component = parts.select("cluster", "n", F.posexplode("sums").alias("at", "sum"))
    found = by_component.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    centres = centres.copy()
    for row in found.collect():  # centroids times components
        centres[row["cluster"], row["at"]] = int(row["sum"]) // row["n"]
    return centres
