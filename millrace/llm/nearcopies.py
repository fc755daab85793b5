"""Near copies: SimHash candidates within a wide radius, then the exact similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import free_name, in_chunks, plain, shuffle_partitions, text_of, written
from millrace.llm.components import components

# Words of a shingle; texts are near copies if they have at least LEAST tenths of their shingles in common.
WORDS, LEAST = 5, 8
# Bits in which the fingerprints of a pair may differ, and then the sketches, that is compared by its shingles. Of pairs
# with exactly 0.8 in common, fingerprints differ in 9.7 bits on average (deviation 2.9), sketches in 25.6 (4.8).
RADIUS, SKETCH_RADIUS = 18, 40
SKETCH_BITS = 256
# Rows of a tile that one task compares with others; more are cut into parts.
TILE_ROWS = 1 << 14
# Pairs of fingerprints that are compared at a time, and rows that look for partners at a time.
BLOCK, STEP_ROWS = 1 << 18, 256
# Shingles whose hashes are minimised at a time.
HASHED = 2048
# Shingles of a part whose texts are compared exactly.
TILE_SHINGLES = 1 << 21
# Bytes of text that a task holds at a time.
TEXT_BYTES = 1_000_000


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle, no words are none."""
    import xxhash

    found = text.lower().split()  # as for fingerprints
    if not found:
        return np.zeros(0, np.int64)
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = min(words, len(found))
    spans = zip(begins[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[b:e]) for b, e in spans), np.uint64).view(np.int64))


def _node(found: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64))


def simhash(found: np.ndarray) -> int:
    """64-bit SimHash of distinct shingles: a bit is set if more than half of them have it."""
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(found), 1 << 16):
        part = found[begin : begin + (1 << 16)].astype("<i8")
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<i8")[0])


_RANDOM = np.random.default_rng(42)
_FACTORS = (_RANDOM.integers(0, 1 << 31, SKETCH_BITS, dtype=np.uint32) * 2 + 1)[:, None]
_SHIFTS = _RANDOM.integers(0, 1 << 32, SKETCH_BITS, dtype=np.uint32)[:, None]


def sketch(found: np.ndarray) -> bytes:
    """One bit of each of ``SKETCH_BITS`` minimum hashes: bits differ in half of 1 - similarity of all places."""
    least = np.full(SKETCH_BITS, np.iinfo(np.uint32).max, dtype=np.uint32)
    raw = found.view(np.uint64)
    short = (raw ^ (raw >> np.uint64(32))).astype(np.uint32)
    for begin in range(0, len(short), HASHED):
        values = _FACTORS * short[None, begin : begin + HASHED]
        values += _SHIFTS
        np.minimum(least, values.min(axis=1), out=least)
    return np.packbits((least >> np.uint32(3)) & np.uint32(1), bitorder="little").tobytes()


def _prints(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_hash, node, fp, size, sketch) of every row; texts with the same set of shingles are one node."""
    rows = docs.select(plain(id_column).alias("id"), _text_hash(text_column).alias("text_hash"), text_of(text_column).cast("binary").alias("_text"))
    schema = T.StructType(rows.drop("_text").schema.fields + T.StructType.fromDDL("node bigint, fp bigint, size bigint, sketch binary").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            found = []
            for text in batch.column("_text"):
                own = shingles(text.as_py())
                found.append((_node(own), simhash(own), len(own), sketch(own)))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*found), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.names)

    return rows.mapInArrow(run, schema)


def _text_hash(text_column: str) -> Column:
    return F.xxhash64(text_of(text_column))


class Rows(NamedTuple):
    """Nodes of a tile in the order of their bit counts."""

    bits: np.ndarray
    node: np.ndarray
    fp: np.ndarray
    size: np.ndarray
    label: np.ndarray
    sketch: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        node, fp, size, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "fp", "size", "label"))
        words = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype="<u8").reshape(len(node), -1)
        return Rows(np.bitwise_count(fp.view(np.uint64)).astype(np.int64), node, fp.view(np.uint64), size, label, words).ordered()

    def ordered(self) -> Rows:
        order = np.argsort(self.bits, kind="stable")
        return Rows(*(c[order] for c in self))

    def with_rows(self, other: Rows) -> Rows:
        return Rows(*(np.concatenate(c) for c in zip(self, other))).ordered()

    def __getitem__(self, rows) -> Rows:
        return Rows(*(c[rows] for c in tuple.__iter__(self)))


def _dealt(nodes: DataFrame, columns: list[str], rows_of: Callable[[int], int]) -> DataFrame:
    """``nodes`` in tiles and parts: (tile, part, home, columns), those at home in a part before its visitors.

    A row is at home in one part of its size class, a visitor in the later parts and in all parts of the next class; parts
    of a class have about ``rows_of(class)`` rows.
    """
    spark = nodes.sparkSession
    tile = F.when(F.col("size") > 0, F.floor(F.log(F.col("size")) / F.log(F.lit(10 / LEAST)))).otherwise(F.lit(-2)).cast("int")
    parts = F.lit(1)
    for row in nodes.groupBy(tile.alias("tile")).count().collect():  # one row per size class
        if (many := -(-row["count"] // rows_of(row["tile"]))) > 1:
            parts = F.when(F.col("tile") == row["tile"], F.lit(many)).otherwise(parts)
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    visits = nodes.select(*columns, tile.alias("own_tile")).withColumn(
        "tile", F.explode(F.array("own_tile", F.col("own_tile") + 1))
    ).withColumn("home", F.col("tile") == F.col("own_tile")).withColumn("own", own)
    placed = visits.withColumn(
        "part", F.explode(F.when(F.col("home"), F.sequence("own", parts - 1)).otherwise(F.sequence(F.lit(0), parts - 1)))
    ).select("tile", "part", (F.col("home") & (F.col("part") == F.col("own"))).alias("home"), *columns)
    return placed.repartition(shuffle_partitions(spark), "tile", "part").sortWithinPartitions("tile", "part", F.desc("home"))


def candidates(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS, give: str = "pairs") -> DataFrame:
    """(u, v): pairs of ``nodes`` (node, fp, size, sketch, label) of different labels that may be near copies.

    These are the pairs whose sizes do not rule the similarity out, whose fingerprints differ in no more than ``radius``
    bits and whose sketches in no more than ``SKETCH_RADIUS``. All three are decided where the rows meet, so that unlike
    texts never become a pair. A tile holds the nodes of one size class, each a quarter larger than the one before, and a
    node visits the next class too. Inside a tile rows are ordered by the bit counts of their fingerprints, and blocks whose
    counts differ by more than the radius are skipped. A tile above ``tile_rows`` is cut into parts, and its visitors go to
    each part. ``give="pairs"`` gives all such pairs, ``"nearest"`` of every row only that with the nearest sketch of each
    part that it meets, and ``"nodes"`` the nodes that are in any pair, as (node, node).
    """
    dealt = _dealt(nodes, ["node", "fp", "size", "label", "sketch"], lambda size_class: tile_rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, None
        for batch in batches:
            tile, part, at_home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            starts = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (part[1:] != part[:-1])]))
            for begin, end in zip(starts, [*starts[1:], len(tile)]):
                if (tile[begin], part[begin]) != key:
                    key, home = (tile[begin], part[begin]), None
                split = begin + int(at_home[begin:end].sum())
                if split > begin:
                    new = Rows.of(batch.slice(begin, split - begin))
                    if home is not None:
                        yield from _near(new, home, radius, give)
                    yield from _near(new, new, radius, give, same=True)
                    home = new if home is None else home.with_rows(new)
                if split < end and home is not None:
                    yield from _near(Rows.of(batch.slice(split, end - split)), home, radius, give)

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _near(rows: Rows, home: Rows, radius: int, give: str, same: bool = False) -> Iterator[pa.RecordBatch]:
    """The pairs of a row and a home, a block at a time."""
    met = np.zeros(len(home.node), dtype=bool)
    for begin in range(0, len(rows.node), STEP_ROWS):
        some = rows[slice(begin, begin + STEP_ROWS)]
        low, high = np.searchsorted(home.bits, [some.bits[0] - radius, some.bits[-1] + radius + 1])
        step = max(1, BLOCK // len(some.node))
        best: list[np.ndarray] = []
        for at in range(max(low, begin + 1 if same else 0), high, step):
            block = home[slice(at, min(high, at + step))]
            r, h = np.nonzero(np.bitwise_count(some.fp[:, None] ^ block.fp[None, :]) <= radius)
            small, great = np.minimum(some.size[r], block.size[h]), np.maximum(some.size[r], block.size[h])
            keep = (some.label[r] != block.label[h]) & (small * 10 >= great * LEAST)
            if same:
                keep &= r + begin < h + at
            r, h = r[keep], h[keep]
            apart = np.bitwise_count(some.sketch[r] ^ block.sketch[h]).sum(axis=1, dtype=np.int64)
            keep = apart <= SKETCH_RADIUS
            r, h, apart = r[keep], h[keep], apart[keep]
            if give == "nodes":
                met[h + at] = True
                own = some.node[np.unique(r)]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(own)], ["u", "v"])
            elif give == "nearest" and len(r):
                order = np.lexsort((apart, r))
                order = order[np.concatenate([[True], r[order[1:]] != r[order[:-1]]])]
                best.append(np.stack([r[order], apart[order], some.node[r[order]], block.node[h[order]]]))
            elif len(r):
                yield pa.RecordBatch.from_arrays([pa.array(some.node[r]), pa.array(block.node[h])], ["u", "v"])
        if best:
            r, apart, u, v = np.concatenate(best, axis=1)
            order = np.lexsort((apart, r))
            order = order[np.concatenate([[True], r[order[1:]] != r[order[:-1]]])]
            yield pa.RecordBatch.from_arrays([pa.array(u[order]), pa.array(v[order])], ["u", "v"])
    if met.any():
        yield pa.RecordBatch.from_arrays([pa.array(home.node[met]), pa.array(home.node[met])], ["u", "v"])


class _Sets:
    """Shingle sets of one part. ``meet`` finds those similar to a set and joins their labels."""

    def __init__(self):
        self.label, self.size, self.node = (np.zeros(0, np.int64) for _ in range(3))
        self.shingle, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, int]] = []
        self.label_of: dict[int, int] = {}

    def add(self, node: int, label: int, found: np.ndarray) -> None:
        self.waiting.append((found, len(self.node)))
        self.label, self.size, self.node = (np.append(x, y) for x, y in ((self.label, label), (self.size, len(found)), (self.node, node)))

    def _index(self) -> None:
        """All shingles in order, with the row that each one is of."""
        shingle = np.concatenate([self.shingle, *(f for f, _ in self.waiting)])
        row = np.concatenate([self.row, *(np.full(len(f), r) for f, r in self.waiting)])
        order = np.argsort(shingle, kind="stable")
        self.shingle, self.row, self.waiting = shingle[order], row[order], []

    def meet(self, node: int, label: int, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links to one row of each label that has a similar one; the labels are then one."""
        both = np.zeros(len(self.node), dtype=np.int64)
        if len(self.waiting) >= 64:
            self._index()
        low, high = (np.searchsorted(self.shingle, found, side) for side in ("left", "right"))
        sizes = high - low
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        both += np.bincount(self.row[at], minlength=len(both))
        for other, row in self.waiting:
            both[row] = len(np.intersect1d(found, other, assume_unique=True))
        similar = both * 10 >= (len(found) + self.size - both) * LEAST
        label = self.label_of.get(label, label)
        rows = np.flatnonzero(similar & (self.label != label))
        labels, first = np.unique(self.label[rows], return_index=True)
        for row in rows[first].tolist():
            yield node, int(self.node[row])
        if len(labels):
            self.label[np.isin(self.label, labels)] = label
            known = set(labels.tolist())
            self.label_of = {old: label if new in known else new for old, new in self.label_of.items()} | dict.fromkeys(known, label)


def similar_links(sets: DataFrame, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """(u, v): links that join all similar texts of ``sets`` (node, size, label, shingles) of different labels.

    Texts of like size meet in tiles as in ``candidates``, with their shingles, and are compared exactly: one look into the
    shingles of a part counts what a text has in common with each text there. A part reports a link only if it joins two
    labels that it has not joined before, so that a group gives no more links than it has texts. Parts are cut so that one
    holds about ``tile_shingles`` shingles.
    """

    def rows_of(size_class: int) -> int:
        return max(1, int(tile_shingles / (10 / LEAST) ** (max(0, size_class) + 1)))

    dealt = _dealt(sets, ["node", "label", "shingles"], rows_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, _Sets()
        for batch in batches:
            links = []
            keys = list(zip(batch.column("tile").to_pylist(), batch.column("part").to_pylist()))
            node, label, at_home = (batch.column(c).to_pylist() for c in ("node", "label", "home"))
            for i, found in enumerate(batch.column("shingles")):
                if keys[i] != key:
                    key, home = keys[i], _Sets()
                own = found.values.to_numpy(zero_copy_only=False)
                links += home.meet(node[i], label[i], own)
                if at_home[i]:
                    home.add(node[i], home.label_of.get(label[i], label[i]), own)
            yield pa.RecordBatch.from_pydict({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return dealt.mapInArrow(run, "u bigint, v bigint")


def _sets(needed: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """(node, shingles) of the nodes ``needed`` (node, text_hash). Only their texts are read again and cut into shingles."""
    schema = "node bigint, shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            sets = [shingles(text.as_py()) for text in batch.column("_text")]
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_node, sets)), pa.int64()), lists], ["node", "shingles"])

    texts = docs.select(_text_hash(text_column).alias("text_hash"), text_of(text_column).cast("binary").alias("_text"))
    texts = texts.join(needed.select("text_hash").distinct().hint("merge"), "text_hash", "left_semi")
    sets = texts.select("_text").mapInArrow(run, schema).groupBy("node").agg(F.first("shingles").alias("shingles"))
    return written(sets, "nearcopies-shingles")


def _similar(pairs: DataFrame, docs: DataFrame, known: DataFrame, text_column: str) -> DataFrame:
    """The ``pairs`` whose shingles are similar."""
    needed = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct().join(known.select("node", "text_hash"), "node")
    sets = _sets(needed, docs, text_column)
    left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("u", "v"))
    both = F.size(F.array_intersect("of_u", "of_v"))
    either = F.size("of_u") + F.size("of_v") - both
    found = pairs.join(left.hint("merge"), "u").join(right.hint("merge"), "v").filter(both * 10 >= either * LEAST)
    return written(found.select("u", "v"), "nearcopies-similar")


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: (id, text_hash, component_id, kept).

    ``component_id`` is the smallest id that similar pairs reach; ``kept`` is true for the row with the smallest id of a
    component and, of several with that id, the smallest hash of the text.

    Texts are similar if at least 0.8 of their distinct five-word shingles (lower-cased A-Z) are common to both. Pairs are
    compared by their shingles if their SimHash fingerprints are within ``radius`` and their sketches of minimum hashes agree
    (see ``candidates``), so no pair is linked that is not similar; of pairs with exactly 0.8 about one in 500 is missed, of
    more similar ones fewer. Links are found twice: first each row with its nearest other one, whose components make a dense
    group one label; then texts that may be similar to one with another label are compared exactly, tile by tile
    (``similar_links``). Neither gives the pairs of a group, similar or not. Comparing the fingerprints is quadratic in the number of distinct texts
    of like size, a few bit operations a pair. Texts are told apart by a 64-bit hash of their shingles.

    NULL texts are empty; texts without words are copies of each other. Repeated rows get equal answers. A NULL id is
    larger than any other. An empty table gives no rows.
    """
    prints = written(_prints(docs, id_column, text_column), "nearcopies-prints")
    known = written(
        prints.groupBy("node").agg(F.min(_rank()).alias("least"), F.min("text_hash").alias("text_hash"), F.min("fp").alias("fp"), F.min("size").alias("size"), F.min("sketch").alias("sketch")),
        "nearcopies-nodes",
    )
    first = written(candidates(known.withColumn("label", F.col("node")), radius, give="nearest").distinct(), "nearcopies-nearest")
    links = _similar(first, docs, known, text_column)
    labels = components(links)
    labelled = known.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = written(labelled.drop("least"), "nearcopies-labels")
    open_ = candidates(labelled, radius, give="nodes").select(F.col("u").alias("node")).distinct()
    open_ = written(labelled.join(open_, "node", "left_semi"), "nearcopies-open")
    sets = open_.select("node", "size", "label").join(_sets(open_, docs, text_column).hint("merge"), "node")
    linked = components(links.unionByName(written(similar_links(sets), "nearcopies-links")))
    with_label = known.join(linked, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "least")
    reached = with_label.groupBy("label").agg(F.min("least").alias("first"))
    answer = written(with_label.join(reached, "label").select("node", "first"), "nearcopies-components")
    return prints.join(answer.hint("merge"), "node").select(
        F.col("id").alias(id_column), "text_hash", F.col("first.id").alias("component_id"), _rank().eqNullSafe(F.col("first")).alias("kept")
    )


def _rank() -> Column:
    """Orders rows by id, NULL last, and by text."""
    return F.struct(F.col("id").isNull().alias("without"), F.col("id"), F.col("text_hash"))


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component (rows repeated whole stay together), with all columns."""
    answer = near_copies(docs, id_column, text_column)
    id_, hash_ = free_name(docs, "dropped_id"), free_name(docs, "dropped_hash")
    dropped = answer.filter(~F.col("kept")).select(
        plain(id_column).alias(id_), F.col("text_hash").alias(hash_)
    )
    same = plain(id_column).eqNullSafe(F.col(id_)) & (_text_hash(text_column) == F.col(hash_))
    return docs.join(dropped.hint("merge"), same, "left_anti")
