"""SimHash near-duplicates: fingerprints, exact comparison by tiles of equal bit counts, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, in_chunks, plain, shuffle_partitions, written
from millrace.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 2
# Fingerprints of a tile that one task compares with others; a larger tile is cut into parts.
TILE_ROWS = 4096
# Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; no words give zero."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, and the six white-space bytes
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(begins[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest, n, ones = xxhash.xxh64_intdigest, 0, np.zeros(64, dtype=np.int64)
    while part := [digest(line[b:e], seed) for b, e in itertools.islice(spans, COUNTED)]:
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) of every row; NULL is an empty text."""
    schema = docs.select(plain(id_column).alias("id")).schema.add("fp", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text"):
            found = [fingerprint(t or b"") for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    return docs.select(plain(id_column).alias("id"), plain(text_column).cast("string").cast("binary").alias("_text")).mapInArrow(run, schema)


def _offsets(radius: int) -> np.ndarray:
    """Differences of eight bit counts that sum up to the radius at most, the first non-zero one positive."""
    steps = range(-radius, radius + 1)
    found = []

    def extend(prefix: tuple[int, ...], left: int) -> None:
        if len(prefix) == 8:
            if any(prefix) and next(d for d in prefix if d) > 0:
                found.append(prefix)
            return
        for d in steps:
            if abs(d) <= left:
                extend((*prefix, d), left - abs(d))

    extend((), radius)
    return np.array(found, dtype=np.int8).reshape(-1, 8)


_PLACES = (16 ** np.arange(8, dtype=np.int64)).astype(np.int64)


def _visits(fps: DataFrame, radius: int) -> DataFrame:
    """(tile, home, fp): each fingerprint in its own tile and, as a visitor, in the later tiles within reach.

    A tile holds the fingerprints with the same bit counts in each of their eight bytes. The counts of two fingerprints
    differ in sum by no more than the fingerprints differ in bits, so all other pairs of tiles are skipped.
    """
    offsets = _offsets(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 8192):
                fp = batch.column(0).slice(begin, 8192).to_numpy(zero_copy_only=False).astype("<i8")
                counts = np.bitwise_count(fp.view(np.uint8).reshape(-1, 8)).astype(np.int8)
                own = counts.astype(np.int64) @ _PLACES
                reached = counts[:, None, :] + offsets[None, :, :]
                row, which = np.nonzero(((reached >= 0) & (reached <= 8)).all(axis=2))
                tile = reached[row, which].astype(np.int64) @ _PLACES
                home = np.zeros(len(fp) + len(row), dtype=bool)
                home[: len(fp)] = True
                columns = [np.concatenate([own, tile]), home, np.concatenate([fp, fp[row]])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["tile", "home", "fp"])

    # each row becomes dozens, so the rows are dealt to all tasks first, by another hash than they lie by already
    dealt = fps.select("fp").repartition(shuffle_partitions(fps.sparkSession), F.xxhash64("fp"))
    return dealt.mapInArrow(run, "tile bigint, home boolean, fp bigint")


class _Forest:
    """Joins fingerprints that are linked; each link that joins two trees is an edge."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[up]
        return node

    def link(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))


def _compare(home: np.ndarray, others: np.ndarray, radius: int, forest: _Forest, same: bool = False) -> None:
    """Link every pair of a home and another fingerprint within the radius, a tile of pairs at a time."""
    width = max(1, (1 << 20) // max(1, len(home)))
    for begin in range(0, len(others), width):
        part = others[begin : begin + width]
        # unsigned, since bits of a negative number are counted by its absolute value
        near = np.bitwise_count(part.view(np.uint64)[:, None] ^ home.view(np.uint64)[None, :]) <= radius
        if same:
            near &= np.arange(begin, begin + len(part))[:, None] < np.arange(len(home))[None, :]
        rows, columns = np.nonzero(near)
        if len(rows):
            # the first home of a row is linked to the row, its further homes to the first one
            first = near.argmax(axis=1)[rows]
            for i in np.flatnonzero(columns == first):
                forest.link(int(part[rows[i]]), int(home[columns[i]]))
            for pair in np.unique(first[columns != first] * len(home) + columns[columns != first]):
                forest.link(int(home[pair // len(home)]), int(home[pair % len(home)]))


def near_links(fps: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v): links between distinct fingerprints at ``radius`` or fewer bits that join all that are within reach.

    ``fps`` has one row per distinct ``fp``. Every pair of fingerprints that can be near is compared; of the pairs found
    near, a task reports a spanning forest of its tile, so that a dense group does not give all its pairs. A tile above
    ``tile_rows`` is cut into parts by a hash, and its visitors go to each part.
    """
    spark = fps.sparkSession
    visits = _visits(fps, radius)
    large = (
        _visits(fps, 0).groupBy("tile").count().filter(F.col("count") > tile_rows)
        .select("tile", F.ceil(F.col("count") / F.lit(tile_rows)).cast("int").alias("parts"))
    )
    large = written(large, "simhash-large-tiles")
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    # to a part: as its own, or as a visitor; in a tile of several parts also from each part to the later ones
    placed = visits.join(large, "tile", "left").select(
        "tile", "home", "fp", own.alias("own"),
        F.explode(F.when(F.col("home"), F.sequence(own, parts - 1)).otherwise(F.sequence(F.lit(0), parts - 1))).alias("part"),
    ).select("tile", "part", (F.col("home") & (F.col("part") == F.col("own"))).alias("home"), "fp")
    dealt = placed.repartition(shuffle_partitions(spark), "tile", "part").sortWithinPartitions("tile", "part", F.desc("home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, forest = None, np.zeros(0, np.int64), _Forest()

        def edges():
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([e[0] for e in forest.edges], pa.int64()), "v": pa.array([e[1] for e in forest.edges], pa.int64())}
            )

        for batch in batches:
            tile, part, at_home, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            starts = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (part[1:] != part[:-1])]))
            for begin, end in zip(starts, [*starts[1:], len(tile)]):
                if (tile[begin], part[begin]) != key:
                    if forest.edges:
                        yield from edges()
                    key, home, forest = (tile[begin], part[begin]), np.zeros(0, np.int64), _Forest()
                if not len(home) and not at_home[begin]:
                    continue  # nobody lives in this tile
                split = begin + int(at_home[begin:end].sum())
                new = fp[begin:split]
                if len(new):
                    _compare(home, new, radius, forest) if len(home) else None
                    _compare(new, new, radius, forest, same=True)
                    home = np.concatenate([home, new])
                if split < end:
                    _compare(home, fp[split:end], radius, forest)
        if forest.edges:
            yield from edges()

    return dealt.mapInArrow(run, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint, component_id).

    ``fingerprint`` is 16 hexadecimal digits; ``component_id`` is the smallest id that near links reach. Copies share a
    fingerprint and are folded into one before anything is compared, so groups of copies cost nothing; only fingerprints
    and ids leave the scan. Intermediate tables (fingerprints, links, each round of the components) are written to the
    shared folder.

    NULL texts are empty; texts without words have the fingerprint zero and are linked like any other. Repeated rows get
    equal answers. NULL ids are never the smallest, unless all of a component are NULL. An empty table gives no rows.
    """
    fps = written(fingerprints(docs, id_column, text_column), "simhash-fingerprints")
    known = fps.groupBy("fp").agg(F.min("id").alias("least"))
    linked = components(near_links(known.select("fp"), radius))
    with_label = linked.join(known, linked["node"] == known["fp"]).select("fp", "label", "least")
    reached = with_label.groupBy("label").agg(F.min("least").alias("component_id"))
    moved = with_label.join(reached, "label").select("fp", "component_id")
    all_known = known.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(written(all_known, "simhash-components").hint("merge"), "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component, with all columns; rows without an id stay."""
    answer = near_duplicates(docs, id_column, text_column)
    name = free_name(docs, "dropped_id")
    dropped = answer.filter(plain(id_column) != F.col("component_id")).select(plain(id_column).alias(name))
    return docs.join(dropped.hint("merge"), plain(id_column) == F.col(name), "left_anti")
