"""Cross-tokenizer alignment: token-byte incidence matrices, their products as links, and how many documents hold a link."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm import bpe, piecebpe
from millrace.llm.common import in_chunks, plain, shuffle_partitions, written

# Segments of a text at whose ends tokens of both kinds end, whatever stands around them. FINE follows the splitting
# pattern of the byte-level vocabulary, for texts without ODD characters (combining marks, carriage returns, numbers that
# are no digits); white space goes with the word behind it where a space joins them. COARSE cuts before a space that follows
# a character that is no white space.
FINE = (
    r"'(?:[stmd]|re|ve|ll)\p{L}*+|(?:\s*+(?<= ))?+(?:\p{L}++|\p{N}++|[^\s\p{L}\p{N}]++)|\s+(?!\S)|\s+"
)
COARSE = r"(?<=\S)(?= )"
ODD = r"[\r\p{M}\p{Nl}\p{No}]"
# Segments that a task remembers before it begins anew, new ones that it aligns at a time, segments of a text held at a
# time, bytes of text taken at a time.
REMEMBERED, NEW_SEGMENTS, HELD_SEGMENTS, TEXT_BYTES = 150_000, 20_000, 500_000, 1_000_000
# Products of matrix entries that are formed at a time.
EXPANDED = 1 << 21
# Pairs of ids, over all documents of a block, after which a block is closed; pairs of a block in one row.
BLOCK_PAIRS, ROW_PAIRS = 2_000_000, 8_192


class Matrix(NamedTuple):
    """A sparse matrix of ones by rows: row ``i`` has ones at ``columns[starts[i]:starts[i + 1]]``, which are sorted."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @staticmethod
    def of_one_column(columns: np.ndarray, width: int) -> Matrix:
        """Every row has a single one."""
        return Matrix(np.arange(len(columns) + 1), columns, width)

    def transposed(self) -> Matrix:
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Matrix(starts, rows[np.argsort(self.columns, kind="stable")], len(self.starts) - 1)


def product(a: Matrix, b: Matrix) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values of ``a`` times ``b``, row by row of ``a`` (Gustavson).

    A row of the product is the sum of the rows of ``b`` that the row of ``a`` has ones for: they are laid out one after
    the other and equal columns counted. So many rows are done at a time that ``EXPANDED`` is not passed; only a row that
    is larger by itself comes alone.
    """
    sizes = np.diff(b.starts)[a.columns]
    before = np.concatenate([[0], np.cumsum(sizes)])  # products before each one of a
    of_row = before[a.starts]
    begin, rows = 0, len(a.starts) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(of_row, of_row[begin] + EXPANDED, side="right")) - 1)
        first, last = a.starts[begin], a.starts[end]
        some = sizes[first:last]
        shift = np.repeat(b.starts[a.columns[first:last]] - (before[first:last] - of_row[begin]), some)
        column = b.columns[shift + np.arange(len(shift))]
        row = np.repeat(np.repeat(np.arange(begin, end), np.diff(a.starts[begin : end + 1])), some)
        yield _counted(row, column, b.width)
        begin = end


def _counted(row: np.ndarray, column: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = row * np.int64(max(1, width)) + column
    if len(key) and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[new] // max(1, width), key[new] % max(1, width), np.diff(np.append(new, len(key)))


def _summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of their amounts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(amounts[order], new) if len(keys) else amounts


class Aligned(NamedTuple):
    """What tokens of texts or segments have in common; the lists have one entry per text."""

    counts: np.ndarray  # n_a, n_b, n_groups, n_links, n_overlaps by columns
    lossless: np.ndarray
    names: list[str]
    starts: np.ndarray  # of each text in pairs
    pairs: np.ndarray  # linked ids as a * width of B + b, sorted within a text
    amounts: np.ndarray  # links of the pair


class Vocabulary:
    """Bytes of the ids of a vocabulary, laid out behind each other."""

    def __init__(self, table: list[bytes]):
        self.width = len(table)
        self.size = np.array([len(t) for t in table], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        return self.flat[np.repeat(self.begin[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


class Tokens(NamedTuple):
    """Ids of some texts, one after the other, and how many each text has."""

    ids: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(lists: list) -> Tokens:
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        return Tokens(np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts)

    def of_texts(self, keep: np.ndarray) -> Tokens:
        """Only the tokens of some texts; the others have none."""
        return Tokens(self.ids[np.repeat(keep, self.counts)], np.where(keep, self.counts, 0))


def _lossless(texts: list[bytes], tokens: Tokens, vocabulary: Vocabulary) -> np.ndarray:
    """Whether the tokens' bytes are those of the text."""
    number, lengths = np.arange(len(texts)), np.array([len(t) for t in texts], dtype=np.int64)
    of_token = np.repeat(number, tokens.counts)
    same = np.bincount(of_token, weights=vocabulary.size[tokens.ids], minlength=len(texts)) == lengths
    raw = np.frombuffer(b"".join(t for t, ok in zip(texts, same) if ok), dtype=np.uint8)
    other = raw != vocabulary.bytes_of(tokens.of_texts(same).ids)
    same[np.repeat(number[same], lengths[same])[other]] = False
    return same


def align(texts: list[bytes], a: Tokens, b: Tokens, of_a: Vocabulary, of_b: Vocabulary) -> Aligned:
    """Align the ids of texts; texts whose bytes one of the two does not give back have no tokens.

    The texts are laid out behind each other, so that one pair of matrices (tokens by bytes) does for all. Their product
    has the overlap links. A group ends where tokens of both kinds end; tokens by groups, multiplied, give the links.
    """
    lossless = _lossless(texts, a, of_a) & _lossless(texts, b, of_b)
    a, b = a.of_texts(lossless), b.of_texts(lossless)
    ends_a, ends_b = np.cumsum(of_a.size[a.ids]), np.cumsum(of_b.size[b.ids])
    total = int(ends_a[-1]) if len(ends_a) else 0
    number, size = np.arange(len(texts)), len(texts)
    text_a = np.repeat(number, a.counts)

    bytes_a = Matrix(np.concatenate([[0], ends_a]), np.arange(total), total)
    bytes_b = Matrix(np.concatenate([[0], ends_b]), np.arange(total), total)
    n_overlaps = np.zeros(size, np.int64)
    for row, _, _ in product(bytes_a, bytes_b.transposed()):
        n_overlaps += np.bincount(text_a[row], minlength=size)

    ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)
    n_groups = np.bincount(text_a[np.searchsorted(ends_a, ends)], minlength=size)
    groups_a, groups_b = (Matrix.of_one_column(g, len(ends)) for g in (group_a, group_b))
    n_links, span = np.zeros(size, np.int64), np.int64(of_a.width) * of_b.width
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for row, column, _ in product(groups_a, groups_b.transposed()):
        n_links += np.bincount(text_a[row], minlength=size)
        found.append(_summed(text_a[row] * span + a.ids[row] * of_b.width + b.ids[column], np.ones(len(row), np.int64)))
    keys, amounts = _summed(*(np.concatenate(x) for x in zip(*found)))
    starts = np.searchsorted(keys, np.arange(size + 1) * span)
    names = _names(a.ids, b.ids, group_a, group_b, a.counts, b.counts)
    return Aligned(np.stack([a.counts, b.counts, n_groups, n_links, n_overlaps], axis=1), lossless, names, starts, keys % span, amounts)


def _names(ids_a, ids_b, group_a, group_b, n_a, n_b) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each text."""
    total = len(ids_a) + len(ids_b)
    # tokens of A before those of B in each group
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, side="left")
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")
    number, group, side = (np.empty(total, dtype=np.int64) for _ in range(3))
    for place, ids, groups, which in ((place_a, ids_a, group_a, 0), (place_b, ids_b, group_b, 1)):
        number[place], group[place], side[place] = ids, groups, which
    parts = [""] * (2 * total)
    parts[0::2] = map(str, number.tolist())
    behind = np.full(total, 2)
    behind[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
    parts[1::2] = map((",", "|", ";").__getitem__, behind.tolist())
    ends = (2 * np.cumsum(n_a + n_b)).tolist()
    return ["".join(parts[begin : max(begin, end - 1)]) for begin, end in zip([0, *ends], ends)]


class Aligner:
    """Aligns the tokens of texts by segments, each distinct segment once until it is forgotten."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str, check: bool = False):
        import regex

        self.a = bpe.Encoder(byte_path, pattern)
        self.b = piecebpe.Encoder(piece_path, check)
        table = bpe.token_bytes(byte_path)
        self.of_a = Vocabulary([table.get(i, b"") for i in range(max(table) + 1)])
        self.of_b = Vocabulary(self._piece_bytes())
        self.fine, self.odd = regex.compile(FINE), regex.compile(ODD)
        # both cuts have to suit the pieces, and the fine one is made for one splitting pattern
        pieces = [p.replace(piecebpe.SPACE, " ") for p in self.b.agenda.merges]
        self.closed = self.b.parts.pattern == piecebpe.PARTS and not any(re.search(COARSE, p) for p in pieces)
        regular = [p for p in pieces if not self.odd.search(p)]
        self.may_be_fine = self.closed and pattern == PATTERN and all(map(self.fine.fullmatch, regular))
        self.forget()

    def _piece_bytes(self) -> list[bytes]:
        library = self.b.library
        found = []
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            found.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace(piecebpe.SPACE, " ").encode())
        return found

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.counts, self.lossless = np.zeros((0, 5), np.int64), np.zeros(0, bool)
        self.names: list[str] = []
        self.starts, self.pairs, self.amounts = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def segments(self, text: str) -> Iterator[list[str]]:
        """Segments of a text, for a very long one part by part."""
        if not self.closed:
            yield [text]
        elif not self.may_be_fine or self.odd.search(text):
            yield re.split(COARSE, text)
        elif len(text) <= HELD_SEGMENTS:
            yield self.fine.findall(text)
        else:
            matches = (m.group() for m in self.fine.finditer(text))
            while part := list(itertools.islice(matches, HELD_SEGMENTS)):
                yield part

    def learn(self, segments: set[str]) -> None:
        """Align the segments that are not known, a batch at a time."""
        new = list(segments.difference(self.known))
        for begin in range(0, len(new), NEW_SEGMENTS):
            some = new[begin : begin + NEW_SEGMENTS]
            found = align([s.encode() for s in some], self._by_a(some), self._by_b(some), self.of_a, self.of_b)
            self.known.update(zip(some, range(len(self.names), len(self.names) + len(some))))
            self.names += found.names
            self.counts = np.concatenate([self.counts, found.counts])
            self.lossless = np.concatenate([self.lossless, found.lossless])
            self.starts = np.concatenate([self.starts, found.starts[1:] + self.starts[-1]])
            self.pairs = np.concatenate([self.pairs, found.pairs])
            self.amounts = np.concatenate([self.amounts, found.amounts])

    def _by_a(self, segments: list[str]) -> Tokens:
        """Most segments are one match of the splitting pattern and go to the library at once."""
        alone = list(map(self.a.pattern.fullmatch, segments))
        ids: list = [None] * len(segments)
        encodings = self.a.tokenizer.encode_batch_fast([m.string for m in alone if m], add_special_tokens=False)
        for at, encoding in zip((i for i, m in enumerate(alone) if m), encodings):
            ids[at] = encoding.ids
        others = [i for i, m in enumerate(alone) if not m]
        for at, found in zip(others, self.a.encode([segments[i] for i in others])):
            ids[at] = found.tolist()
        return Tokens.of(ids)

    def _by_b(self, segments: list[str]) -> Tokens:
        """Most segments are one part and go to the agenda at once."""
        escaped = [s.replace(" ", piecebpe.SPACE) for s in segments]
        ids: list = [None] * len(segments)
        alone = [i for i, s in enumerate(escaped) if len(s) <= piecebpe.REMEMBERED_CHARS and self.b.parts.fullmatch(s)]
        for at, found in zip(alone, self.b.short([escaped[i] for i in alone])):
            ids[at] = found.tolist()
        others = [i for i, found in enumerate(ids) if found is None]
        for at, found in zip(others, self.b.encode_escaped([escaped[i] for i in others])):
            ids[at] = found.tolist()
        return Tokens.of(ids)

    def pairs_of(self, segments: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair and number of links, sorted, of segments that stand in texts."""
        both, times = np.unique(texts * np.int64(len(self.names)) + segments, return_counts=True)
        text, segment = both // max(1, len(self.names)), both % max(1, len(self.names))
        sizes = np.diff(self.starts)[segment]
        at = np.repeat(self.starts[segment] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        span = np.int64(self.of_a.width) * self.of_b.width
        keys, amounts = _summed(np.repeat(text, sizes) * span + self.pairs[at], np.repeat(times, sizes) * self.amounts[at])
        return keys // span, keys % span, amounts

    def documents(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray]]:
        """Counts, digest of the groups, pairs and their links of each text (behind a space)."""
        whole = [list(self.segments(" " + t)) if len(t) <= HELD_SEGMENTS and t else None for t in texts]
        self._make_room()
        every = list(itertools.chain.from_iterable(part for parts in whole if parts for part in parts))
        self.learn(set(every))
        sizes = np.array([sum(map(len, parts)) if parts else 0 for parts in whole], dtype=np.int64)
        number = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        numbers = np.split(number, np.cumsum(sizes)[:-1])
        # texts that are not given back as they are have no tokens
        numbers = [n if self.lossless[n].all() else n[:0] for n in numbers]
        text, pair, amount = self.pairs_of(np.concatenate(numbers), np.repeat(np.arange(len(texts)), [len(n) for n in numbers]))
        cuts = np.searchsorted(text, np.arange(len(texts) + 1))
        short = [
            (self.counts[n].sum(axis=0), self._digest(n), pair[cuts[i] : cuts[i + 1]], amount[cuts[i] : cuts[i + 1]])
            for i, n in enumerate(numbers)
        ]
        for t, parts, found in zip(texts, whole, short):
            yield found if parts or not t else self._long(" " + t)

    def _make_room(self) -> None:
        if len(self.known) > REMEMBERED:
            self.forget()

    def _digest(self, numbers: np.ndarray) -> str:
        names = ";".join(map(self.names.__getitem__, numbers.tolist()))
        return hashlib.sha256(names.encode()).hexdigest() if len(numbers) else ""

    def _long(self, text: str) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """As ``documents`` for one text, held part by part."""
        counts, digest, keys, amounts = np.zeros(5, np.int64), hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        begun = False
        for part in self.segments(text):
            for begin in range(0, len(part), HELD_SEGMENTS):
                some = part[begin : begin + HELD_SEGMENTS]
                self._make_room()
                self.learn(set(some))
                numbers = np.array(list(map(self.known.__getitem__, some)), dtype=np.int64)
                if not self.lossless[numbers].all():
                    return np.zeros(5, np.int64), "", keys[:0], amounts[:0]
                counts += self.counts[numbers].sum(axis=0)
                digest.update(b";" * begun + ";".join(map(self.names.__getitem__, numbers.tolist())).encode())
                begun = True
                _, pair, amount = self.pairs_of(numbers, np.zeros(len(numbers), np.int64))
                keys, amounts = _summed(np.concatenate([keys, pair]), np.concatenate([amounts, amount]))
        return counts, digest.hexdigest(), keys, amounts


# The splitting pattern of byte-level vocabularies that FINE is made for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, so that the empty upper planes compress to nothing."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view("<u8").astype(np.int64)


def _aligned_blocks(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, text_column: str, keep: tuple[str, ...], check: bool) -> DataFrame:
    """Rows of two kinds: documents with their pairs as places in the list of their block, and the lists of the blocks.

    A block is a run of documents of one task. ``at`` is NULL for documents, else the place of the first listed pair.
    """
    lists = "_block bigint, _at bigint, _a array<int>, _b array<int>, _n array<bigint>"
    own = "".join(f", _{c} bigint" for c in COUNTS) + ", _sha string, _places binary, _amounts binary, _keep boolean"
    schema = T.StructType(docs.select(*[plain(k) for k in keep]).schema.fields + T.StructType.fromDDL(lists + own).fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, pattern, piece_path, check)
        width = aligner.of_b.width
        block, held, rows, size = TaskContext.get().partitionId() << 33, [], [], 0

        def closed() -> Iterator[pa.RecordBatch]:
            every, place = np.unique(np.concatenate([d[2] for d in held]), return_inverse=True)
            documents = np.bincount(place, minlength=len(every))
            cuts = np.cumsum([0, *(len(d[2]) for d in held)])
            places = [place[b:e] for b, e in zip(cuts, cuts[1:])]
            at = 0
            for part in rows:
                some = held[at : at + part.num_rows]
                columns = {
                    "_block": pa.array([block] * len(some), pa.int64()),
                    **{f"_{c}": pa.array([int(d[0][i]) for d in some], pa.int64()) for i, c in enumerate(COUNTS)},
                    "_sha": pa.array([d[1] for d in some], pa.string()),
                    "_places": pa.array([_packed(np.diff(p, prepend=0)) for p in places[at : at + len(some)]], pa.binary()),
                    "_amounts": pa.array([_packed(d[3]) for d in some], pa.binary()),
                    "_keep": pa.array([True] * len(some)),
                }
                yield whole(part, columns)
                at += part.num_rows
            for begin in range(0, len(every), ROW_PAIRS * 8):
                cut = range(begin, min(len(every), begin + ROW_PAIRS * 8), ROW_PAIRS)
                lists = {"_a": every // width, "_b": every % width, "_n": documents}
                columns = {"_block": pa.array([block] * len(cut), pa.int64()), "_at": pa.array(list(cut), pa.int64())}
                for name, values in lists.items():
                    kind = pa.list_(pa.int64() if name == "_n" else pa.int32())
                    columns[name] = pa.array([values[c : c + ROW_PAIRS] for c in cut], kind)
                yield whole(None, columns)

        def whole(part, columns) -> pa.RecordBatch:
            count = len(columns["_block"])
            found = [
                columns[n] if n in columns else part.column(i) if part is not None and i < len(keep) else pa.nulls(count, types.field(i).type)
                for i, n in enumerate(names)
            ]
            return pa.RecordBatch.from_arrays(found, names)

        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            held += aligner.documents([t or "" for t in batch.column("_text").to_pylist()])
            rows.append(batch)
            size += sum(len(d[2]) for d in held[-batch.num_rows :])
            if size >= BLOCK_PAIRS:
                yield from closed()
                block, held, rows, size = block + 1, [], [], 0
        if held:
            yield from closed()

    types = to_arrow_schema(schema)
    return docs.select(*[plain(k) for k in keep], plain(text_column).cast("string").alias("_text")).mapInArrow(run, schema)


def align_tokenizers(
    docs: DataFrame, byte_path: str, pattern: str, piece_path: str, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
    check: bool = False,
) -> DataFrame:
    """Columns ``keep`` and n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum and groups_sha256 of every row.

    Tokens of the space-prefixed text by a byte-level vocabulary (A) and by a piece vocabulary (B) cover the same bytes.
    ``n_overlaps`` counts pairs of tokens that share a byte, ``n_links`` those that share a group. A pair of ids counts in
    how many documents it is linked; ``n_best`` are the links whose count is the highest of their id of A, ``count_sum`` adds
    the counts over the links.

    Documents of a task are cut into blocks. A block lists its distinct pairs once, with the number of its documents that
    hold them; these lists are summed over all blocks, and the sums return to the lists and, by block, to the documents. So
    what is shuffled by pairs are lists of blocks, in which a frequent pair stands once.

    NULL and empty texts, and texts that one vocabulary does not give back as they are (B writes U+2581 as a space), have no
    tokens: all zeros, and '' for the groups. Repeated rows are documents of their own. Columns not in ``keep`` are dropped,
    so their names cannot clash; those of the result may not be among ``keep``. An empty table gives no rows.
    """
    spark = docs.sparkSession
    renamed = docs.select(*[plain(k).alias(f"_k{i}") for i, k in enumerate(keep)], plain(text_column).alias("_t"))
    own = tuple(f"_k{i}" for i in range(len(keep)))
    blocks = written(_aligned_blocks(renamed, byte_path, pattern, piece_path, "_t", own, check), "alignment-blocks")
    lists = blocks.filter("_at IS NOT NULL").select("_block", "_at", F.posexplode(F.arrays_zip("_a", "_b", "_n")).alias("i", "x")).select(
        "_block", (F.col("_at") + F.col("i")).alias("_at"), F.col("x._a").alias("_a"), F.col("x._b").alias("_b"), F.col("x._n").alias("_n")
    )
    counts = written(lists.groupBy("_a", "_b").agg(F.sum("_n").alias("_count")), "alignment-counts")
    # as many rows as A has ids
    most = F.broadcast(counts.groupBy("_a").agg(F.max("_count").alias("_most")))
    judged = counts.join(most, "_a").select("_a", "_b", "_count", (F.col("_count") == F.col("_most")).alias("_best"))
    back = lists.drop("_n").join(judged.hint("merge"), ["_a", "_b"]).select("_block", "_at", "_count", "_best")
    empty = {c: F.lit(None).cast(kind) for c, kind in (("_at", "bigint"), ("_count", "bigint"), ("_best", "boolean"))}
    rows = blocks.filter("_keep").drop("_a", "_b", "_n", "_at", "_keep").withColumns(empty)
    both = back.unionByName(rows, allowMissingColumns=True)
    dealt = both.repartition(shuffle_partitions(spark), "_block").sortWithinPartitions("_block", F.col("_at").asc_nulls_last())
    sums = ", ".join(f"{name} bigint" for name in (*COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
    schema = T.StructType(docs.select(*[plain(k) for k in keep]).schema.fields + T.StructType.fromDDL(sums).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counted, best = None, [], []
        for batch in batches:
            block, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_block", "_at"))
            listed = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), dtype=bool)
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            for begin, end in zip(starts, [*starts[1:], len(block)]):
                if block[begin] != key:
                    key, counted, best = block[begin], [], []
                split = begin + int(listed[begin:end].sum())
                if split > begin:
                    counted.append(batch.column("_count").slice(begin, split - begin).to_numpy(zero_copy_only=False).astype(np.int64))
                    best.append(batch.column("_best").slice(begin, split - begin).to_numpy(zero_copy_only=False).astype(bool))
                if split == end:
                    continue
                counted, best = ([np.concatenate(x)] if x else [np.zeros(0, np.int64)] for x in (counted, best))
                part = batch.slice(split, end - split)
                sums, bests = [], []
                for places, amounts in zip(part.column("_places").to_pylist(), part.column("_amounts").to_pylist()):
                    place, amount = np.cumsum(_unpacked(places)), _unpacked(amounts)
                    sums.append(int((counted[0][place] * amount).sum()))
                    bests.append(int(amount[best[0][place].astype(bool)].sum()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in own), *(part.column(f"_{c}") for c in COUNTS), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), part.column("_sha")],
                    schema.names,
                )

    return dealt.mapInArrow(run, schema)
