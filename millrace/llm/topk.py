"""Exact inner-product search: vectors keyed by nearest pivot and distance, annuli searched outwards within bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import plain, shuffle_partitions, written

# Pivots are fitted on at most so many vectors, those with the smallest hashes of their ids.
FIT_ROWS, PIVOTS, RINGS = 4096, 8, 8
# Vectors of a cell that one task holds; a larger annulus is split by a hash of the id.
CELL_ROWS = 16_384
# Vectors of an annulus that are compared at a time, and queries that meet them.
STEP_ROWS, QUERY_ROWS = 256, 1024
SCALE = 256.0


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): components as floor(SCALE * x), packed as 64-bit numbers.

    Left out: NULL vectors, vectors with a NULL, infinite or not-a-number component, and rows without an id. An empty
    vector stays; its product with any other is zero.
    """
    vector = plain(vector_column).cast("array<double>")
    usable = vector.isNotNull() & plain(id_column).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.floor(SCALE * np.array(x, dtype=np.float64)).astype("<i8").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "v"])

    kept = vectors.filter(usable).select(plain(id_column).cast("long").alias("id"), vector.alias("x"))
    return kept.mapInArrow(run, "id bigint, v binary")


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, the shorter ones filled up with zeros."""
    rows = column.to_pylist()
    found = np.zeros((len(rows), width), dtype=np.int64)
    for row, raw in enumerate(rows):
        values = np.frombuffer(raw, dtype="<i8")
        found[row, : len(values)] = values
    return found


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 10) -> np.ndarray:
    """Means of nearby vectors (k-means from spread-out starting points)."""
    x = sample.astype(np.float64)
    if len(x) == 0:
        return np.zeros((1, sample.shape[1]))
    chosen = [0]
    nearest = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < pivots and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    centres = x[chosen]
    for _ in range(rounds):
        near = (x @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        centres = np.stack([x[near == p].mean(axis=0) if (near == p).any() else centres[p] for p in range(len(centres))])
    return centres


def products(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in floating point while that is exact, else in 64-bit numbers."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    if largest < 2**53:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


class Space:
    """Vectors as points one dimension up, all at the distance ``radius`` from the origin; queries stay where they are.

    There, the nearer point has the larger inner product with the query, and distances obey the triangle inequality.
    """

    def __init__(self, pivots: np.ndarray, radius2: float):
        self.pivots, self.radius2 = pivots, radius2
        self.norms = (pivots**2).sum(axis=1)

    def of_vectors(self, v: np.ndarray) -> np.ndarray:
        """Distances to the pivots."""
        return np.sqrt(np.maximum(self.radius2 + self.norms - 2 * (v.astype(np.float64) @ self.pivots.T), 0.0))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] + self.norms - 2 * (q @ self.pivots.T), 0.0))

    def best_score(self, q: np.ndarray, gap: np.ndarray) -> np.ndarray:
        """No vector whose distance to a pivot differs from the query's by ``gap`` or more scores above this.

        A little is added for rounding.
        """
        both = (q.astype(np.float64) ** 2).sum(axis=-1) + self.radius2
        return (both - gap**2) / 2 + 1e-7 * both + 1e-3


def _gap(distance: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, np.maximum(low - distance, distance - high))


class Search:
    """The ``k`` best of one cell for queries that come in batches."""

    def __init__(self, space: Space, pivot: int, ids: np.ndarray, vectors: np.ndarray, distances: np.ndarray, k: int):
        self.space, self.pivot, self.k = space, pivot, k
        order = np.argsort(distances, kind="stable")
        cut = [order[i : i + STEP_ROWS] for i in range(0, len(order), STEP_ROWS)]
        self.steps = [(ids[c], vectors[c]) for c in cut]
        self.low = np.array([distances[c[0]] for c in cut])
        self.high = np.array([distances[c[-1]] for c in cut])

    def run(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """Annuli of a query are taken from its own distance outwards, until no further one can reach its k-th score."""
        n, k = len(query_ids), self.k
        distance = self.space.of_queries(queries)[:, self.pivot]
        bound = self.space.best_score(queries[:, None, :], _gap(distance[:, None], self.low, self.high))
        order = np.argsort(-bound, axis=1, kind="stable")
        scores = np.full((n, k), np.iinfo(np.int64).min)
        found = np.full((n, k), np.iinfo(np.int64).max)
        least = least.copy()
        for turn in range(len(self.steps)):
            step = order[:, turn]
            open_ = np.flatnonzero(bound[np.arange(n), step] >= least)
            if not len(open_):
                break
            for s in np.unique(step[open_]):
                rows = open_[step[open_] == s]
                ids, vectors = self.steps[s]
                new = products(vectors, queries[rows])
                all_ids = np.concatenate([found[rows], np.broadcast_to(ids, new.shape)], axis=1)
                new[ids[None, :] == query_ids[rows][:, None]] = np.iinfo(np.int64).min
                all_scores = np.concatenate([scores[rows], new], axis=1)
                best = _best(all_scores, all_ids, k)
                scores[rows] = np.take_along_axis(all_scores, best, axis=1)
                found[rows] = np.take_along_axis(all_ids, best, axis=1)
                least[rows] = np.maximum(least[rows], scores[rows, k - 1].astype(np.float64))
        row, column = np.nonzero(scores > np.iinfo(np.int64).min)
        return query_ids[row], found[row, column], scores[row, column]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest scores, of equal scores the smallest ids."""
    return np.lexsort((ids, ~scores), axis=1)[:, :k]  # ~x = -x - 1: the order of x reversed, without overflow


def _cells(index: DataFrame, visits: DataFrame, space: Space, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each cell for each query that visits it."""
    spark = index.sparkSession
    home = index.select("pivot", "ring", "salt", F.lit(True).alias("home"), "id", "v", "distance")
    guests = visits.select("pivot", "ring", "salt", F.lit(False).alias("home"), "id", "v", F.col("least").alias("distance"))
    dealt = (
        home.unionByName(guests)
        .repartition(shuffle_partitions(spark), "pivot", "ring", "salt")
        .sortWithinPartitions("pivot", "ring", "salt", F.desc("home"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, distances, search = None, [], [], [], None
        for batch in batches:
            cell = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "ring", "salt")], axis=1)
            at_home = batch.column("home").to_numpy(zero_copy_only=False)
            number = batch.column("id").to_numpy(zero_copy_only=False)
            amount = batch.column("distance").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)]))
            for begin, end in zip(starts, [*starts[1:], len(cell)]):
                if tuple(cell[begin]) != key:
                    key, ids, vectors, distances, search = tuple(cell[begin]), [], [], [], None
                split = begin + int(at_home[begin:end].sum())
                if split > begin:
                    ids.append(number[begin:split])
                    vectors.append(unpacked(batch.column("v").slice(begin, split - begin), width))
                    distances.append(amount[begin:split])
                if split == end or not ids:
                    continue
                if search is None:
                    search = Search(space, key[0], np.concatenate(ids), np.concatenate(vectors), np.concatenate(distances), k)
                for at in range(split, end, QUERY_ROWS):
                    size = min(QUERY_ROWS, end - at)
                    found = search.run(number[at : at + size], unpacked(batch.column("v").slice(at, size), width), amount[at : at + size])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])

    return dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    pivots: int = PIVOTS, rings: int = RINGS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose id is divisible by ``every``, the ``k`` best rows with other ids.

    The score is the inner product of the whole-number vectors, ties go to the smaller id; the result is exact. Fewer
    than ``k`` other rows: all of them.

    Every vector is keyed by its nearest pivot and its distance to it; the distances of a pivot are cut into ``rings``, and
    a ring above ``cell_rows`` vectors into salted cells, so that equal vectors, however many, never meet in one task. A
    query first searches the ring that it falls into; its k-th score there bounds the distance of anything better, and
    by the triangle inequality it then visits only the rings that reach into that distance. Inside a cell, vectors are
    sorted by distance and searched outwards from the query's until the bound stops it. Pivots and cut points of the rings
    come from a bounded sample and from counts per ring, never from the vectors as a whole.

    Rows repeated with one id and one vector count once. Vectors of other lengths are filled up with zeros. Scores have to
    fit in 64 bits. An empty table gives no rows. See ``whole_vectors`` for the rows that are left out.
    """
    spark = vectors.sparkSession
    whole = written(whole_vectors(vectors, id_column, vector_column).distinct(), "topk-vectors")

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        largest, width = 0.0, 1
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                v = np.frombuffer(raw, dtype="<i8").astype(np.float64)
                largest, width = max(largest, float((v * v).sum())), max(width, len(v))
        yield pa.RecordBatch.from_pydict({"norm2": pa.array([largest]), "width": pa.array([width], pa.int64())})

    bounds = whole.select("v").mapInArrow(norms, "norm2 double, width bigint").agg(F.max("norm2"), F.max("width")).first()
    if bounds[0] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    radius2, width = float(bounds[0]), int(bounds[1])
    sample = whole.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("v").toArrow().column(0)
    space = Space(fit_pivots(unpacked(sample, width), pivots), radius2)

    sampled = space.of_vectors(unpacked(sample, width))
    nearest = sampled.argmin(axis=1)
    cuts = [np.unique(np.quantile(sampled[nearest == p, p], np.linspace(0, 1, rings + 1)[1:-1])) if (nearest == p).any() else np.zeros(0) for p in range(len(space.pivots))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = unpacked(batch.column("v"), width)
            distances = space.of_vectors(v)
            pivot = distances.argmin(axis=1)
            own = distances[np.arange(len(v)), pivot]
            ring = np.array([np.searchsorted(cuts[p], d, side="right") for p, d in zip(pivot, own)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(ring), pa.array(own)], ["id", "v", "pivot", "ring", "distance"]
            )

    index = written(whole.mapInArrow(place, "id bigint, v binary, pivot int, ring int, distance double"), "topk-index")
    counted = index.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")
    ).collect()  # pivots times rings at most
    salts = {(c["pivot"], c["ring"]): -(-c["n"] // cell_rows) for c in counted}
    limits = {(c["pivot"], c["ring"]): (c["low"], c["high"]) for c in counted}
    cells = sorted(salts)
    low, high = (np.array([limits[c][side] for c in cells]) for side in (0, 1))
    of_pivot = np.array([c[0] for c in cells])

    salt_of = F.create_map(*[F.lit(x) for (p, r), n in salts.items() for x in (p * 1000 + r, n)])
    salt = F.pmod(F.xxhash64("id"), F.element_at(salt_of, F.col("pivot") * 1000 + F.col("ring"))).cast("int")
    index = index.withColumn("salt", salt)

    visit_schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("v", T.BinaryType()), T.StructField("least", T.DoubleType()),
        T.StructField("pivot", T.IntegerType()), T.StructField("ring", T.IntegerType()), T.StructField("salt", T.IntegerType()),
    ])

    def visits(first: bool):
        """Cells of queries (id, v, least): the cell they fall into, or all others that may hold something better."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                q = unpacked(batch.column("v"), width)
                least = batch.column("least").to_numpy(zero_copy_only=False)
                gap = _gap(space.of_queries(q)[:, of_pivot], low, high)
                own = np.zeros(gap.shape, dtype=bool)
                own[np.arange(len(q)), gap.argmin(axis=1)] = True
                wanted = own if first else ~own & (space.best_score(q[:, None, :], gap) >= least[:, None])
                row, cell = np.nonzero(wanted)
                repeat = np.array([salts[c] for c in cells])[cell]
                row, cell = np.repeat(row, repeat), np.repeat(cell, repeat)
                number = np.concatenate([np.arange(r) for r in repeat]) if len(repeat) else np.zeros(0)
                taken = batch.take(pa.array(row, pa.int64()))
                place_ = np.array(cells, dtype=np.int32).reshape(-1, 2)[cell]
                yield pa.RecordBatch.from_arrays(
                    [taken.column("id"), taken.column("v"), taken.column("least"), pa.array(place_[:, 0]), pa.array(place_[:, 1]), pa.array(number.astype(np.int32))],
                    [f.name for f in visit_schema.fields],
                )

        return run

    queries = whole.filter(F.col("id") % every == 0)
    started = queries.withColumn("least", F.lit(float("-inf"))).mapInArrow(visits(True), visit_schema)
    near = written(_cells(index, started, space, width, k), "topk-near")
    # the k-th score that is already there
    order = F.sort_array(F.collect_list("score"), asc=False)
    least = near.groupBy(F.col("query_id").alias("id")).agg(F.try_element_at(order, F.lit(k)).cast("double").alias("least"))
    known = queries.join(least, "id", "left").select("id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    far = _cells(index, known.mapInArrow(visits(False), visit_schema), space, width, k)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("under"), "vec_id"))), 1, k)
    ranked = near.unionByName(far).groupBy("query_id").agg(best.alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.under")).alias("score")
    )
