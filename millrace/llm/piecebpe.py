"""Piece BPE: encoding by a score-ordered agenda, checked against the sentencepiece library, and decoding."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import in_chunks, plain

# What stands for a space in the vocabulary.
SPACE = "▁"
# Parts of a text between which no piece of a vocabulary may reach (this is verified when it is loaded): a run of spaces
# with the letters or the other characters behind it (a carriage return among these); other white space; and spaces alone.
PARTS = rf"{SPACE}*+(?:[\p{{L}}\p{{M}}]++|(?:[^\p{{L}}\p{{M}}\s{SPACE}]|\r)++)|{SPACE}++|[^\S\r]"
# Parts up to this length are merged many at a time, others one by one; a task forgets the parts that it knows when they
# are more than so many, which changes no result.
REMEMBERED_CHARS, REMEMBERED_PARTS = 64, 300_000
# New parts that are merged at a time, parts that the library checks as one text, characters whose parts are held at a
# time, bytes of text that a task takes at a time.
NEW_PARTS, CHECKED_PARTS, HELD_PARTS, TEXT_BYTES = 20_000, 100, 2_000_000, 1_000_000
# A character that no piece holds beside another one; parts are checked behind it, where they stand as in a text.
FENCE = "\n"
# Place of a pair that makes no piece.
NOWHERE = np.int64(1) << 40


class Agenda:
    """Merges symbols of a vocabulary of the merge type, the pair with the highest score first, the leftmost of equal ones.

    ``one`` is the agenda of a single text as a queue. ``many`` does the same for many short texts at once: each step takes
    the first pair of every text off its agenda, which is a slice of one array.
    """

    def __init__(self, scores: dict[str, float], ids: dict[str, int]):
        """``scores`` of the pieces of two or more characters, ``ids`` of all pieces."""
        self.merges = {piece: -score for piece, score in scores.items()}
        # symbols as numbers: ids of pieces, and behind them the characters that are no piece
        self.size = max(ids.values(), default=0) + 1
        self.of_character = np.arange(self.size, self.size + 0x110000, dtype=np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_character[ord(piece)] = i
        order = {score: place for place, score in enumerate(sorted(set(self.merges.values())))}
        found = []
        for piece, score in self.merges.items():
            for cut in range(1, len(piece)):
                sides = [ids.get(p, self.of_character[ord(p)] if len(p) == 1 else None) for p in (piece[:cut], piece[cut:])]
                if None not in sides:
                    found.append(((int(sides[0]) << 21) | int(sides[1]), order[score], ids[piece]))
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
        self.pairs, self.places, self.made = (np.ascontiguousarray(table[:, c]) for c in range(3))

    def one(self, text: str) -> list[str]:
        """The pieces of a text."""
        symbols, merges = list(text), self.merges
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            piece = symbols[i] + symbols[i + 1]
            if (score := merges.get(piece)) is not None:
                agenda.append((score, i, piece))
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue  # one of the two has become longer meanwhile
            symbols[i], symbols[j] = piece, ""
            after[i] = far = after[j]
            if far < n:
                before[far] = i
                longer = piece + symbols[far]
                if (score := merges.get(longer)) is not None:
                    heapq.heappush(agenda, (score, i, longer))
            if (near := before[i]) >= 0:
                longer = symbols[near] + piece
                if (score := merges.get(longer)) is not None:
                    heapq.heappush(agenda, (score, near, longer))
        return [s for s in symbols if s]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair in the order of scores, and the symbol that it becomes; no piece: the last place."""
        if not len(self.pairs):
            return np.full(len(left), NOWHERE), np.zeros(len(left), np.int64)
        pair = (left << 21) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = self.pairs[at] == pair
        return np.where(hit, self.places[at], NOWHERE), self.made[at]

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts one after the other, and how many each text has."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        symbol, text = self.of_character[points], np.repeat(np.arange(len(texts)), lengths)
        place, made = self._pairs_of(symbol, text)
        done_symbols, done_texts = [], []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            sizes = np.diff(np.append(starts, len(text)))
            top = np.minimum.reduceat(place, starts)
            open_ = top < NOWHERE
            if not open_.all():  # an agenda that is empty
                keep = np.repeat(open_, sizes)
                done_symbols.append(symbol[~keep])
                done_texts.append(text[~keep])
                symbol, text, place, made = symbol[keep], text[keep], place[keep], made[keep]
                if not len(symbol):
                    break
                sizes, top = sizes[open_], top[open_]
                starts = np.cumsum(sizes) - sizes
            is_top = np.flatnonzero(place == np.repeat(top, sizes))
            # the leftmost of each text
            at = is_top[np.concatenate([[True], text[is_top[1:]] != text[is_top[:-1]]])]
            symbol[at] = made[at]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            at = np.cumsum(stay)[at] - 1
            symbol, text, place, made = symbol[stay], text[stay], place[stay], made[stay]
            changed = np.concatenate([at, at[at > 0] - 1])
            inside = np.zeros(len(changed), dtype=bool)
            last = changed + 1 >= len(symbol)
            inside[~last] = text[changed[~last]] == text[changed[~last] + 1]
            place[changed[~inside]] = NOWHERE
            changed = changed[inside]
            place[changed], made[changed] = self._look_up(symbol[changed], symbol[changed + 1])
        if not done_texts:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        text = np.concatenate(done_texts)
        order = np.argsort(text, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(text, minlength=len(texts))

    def _pairs_of(self, symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol the place and the symbol of the pair with the next one of its text."""
        place, made = np.full(len(symbol), NOWHERE), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            inside = np.flatnonzero(text[1:] == text[:-1])
            place[inside], made[inside] = self._look_up(symbol[inside], symbol[inside + 1])
        return place, made


class Encoder:
    """Ids of texts for a vocabulary of the merge type, by ``Agenda``; characters without a piece become their bytes.

    The agenda runs per part of a text (``PARTS``) and once for equal parts. With ``check`` each of these is compared with
    the library, and a difference raises.
    """

    def __init__(self, model_path: str, check: bool = True):
        import regex
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        with open(model_path, "rb") as file:
            model = model_pb2.ModelProto.FromString(file.read())
        kinds = model_pb2.ModelProto.SentencePiece
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != model_pb2.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("the vocabulary is not of the merge type with byte pieces")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("the vocabulary changes texts before it splits them")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("the vocabulary has pieces that are taken whole or left out")
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.check = check
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL and len(p.piece) > 1}
        self.agenda = Agenda(scores, self.ids)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        parts = regex.compile(PARTS)
        # a vocabulary with other pieces is encoded by whole texts
        self.parts = parts if all(map(parts.fullmatch, scores)) else regex.compile(r"(?s).+")
        self.fence = self._bytes(FENCE)
        self.known: dict[str, bytes] = {}

    def _bytes(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()]

    def _long(self, part: str) -> np.ndarray:
        found = []
        for piece in self.agenda.one(part):
            found += [i] if (i := self.ids.get(piece)) is not None else self._bytes(piece)
        return np.array(found, dtype=np.int32)

    def _merged(self, parts: list[str]) -> list[np.ndarray]:
        symbols, counts = self.agenda.many(parts)
        other = np.flatnonzero(symbols >= self.agenda.size)
        if len(other):
            as_bytes = [self._bytes(chr(s - self.agenda.size)) for s in symbols[other].tolist()]
            sizes = np.ones(len(symbols), dtype=np.int64)
            sizes[other] = [len(b) for b in as_bytes]
            counts = np.add.reduceat(sizes, np.cumsum(counts) - counts) if len(counts) else counts
            replaced = np.zeros(len(symbols), dtype=bool)
            replaced[other] = True
            symbols = np.repeat(symbols, sizes)
            symbols[np.repeat(replaced, sizes)] = [i for b in as_bytes for i in b]
        symbols = symbols.astype(np.int32)
        ends = np.cumsum(counts)
        return [symbols[b:e] for b, e in zip((ends - counts).tolist(), ends.tolist())]

    def _learn(self, new: list[str]) -> None:
        """Encode parts and let the library encode them too, each behind a character that no other piece reaches over."""
        short = [p for p in new if len(p) <= REMEMBERED_CHARS]
        long = [p for p in new if len(p) > REMEMBERED_CHARS]
        for begin in range(0, len(short), NEW_PARTS):
            some = short[begin : begin + NEW_PARTS]
            self._keep(some, self._merged(some))
        for part in long:
            self._keep([part], [self._long(part)])

    def short(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of parts of at most ``REMEMBERED_CHARS``, without remembering them."""
        found = self._merged(parts)
        self._compare(parts, found)
        return found

    def _keep(self, parts: list[str], found: list[np.ndarray]) -> None:
        self._compare(parts, found)
        self.known.update(zip(parts, map(np.ndarray.tobytes, found)))

    def _compare(self, parts: list[str], found: list[np.ndarray]) -> None:
        for begin in range(0, len(parts) if self.check else 0, CHECKED_PARTS):
            some = parts[begin : begin + CHECKED_PARTS]
            own = [i for ids in found[begin : begin + CHECKED_PARTS] for i in [*self.fence, *ids.tolist()]]
            if self.parts.pattern != PARTS:
                own, text = own[len(self.fence) :], some[0][1:]
            else:
                own, text = [self.ids[SPACE], *own], FENCE + FENCE.join(some)
            if self.library.encode(text) != own:
                raise ValueError(f"agenda and library differ within {text[:200]!r}")

    def escaped(self, escaped: str) -> bytes:
        """Ids of a text whose spaces are escaped, 32 bits each."""
        found = []
        matches = (m.group() for m in self.parts.finditer(escaped)) if len(escaped) > HELD_PARTS else None
        while parts := list(itertools.islice(matches, HELD_PARTS)) if matches else self.parts.findall(escaped):
            self.learn(set(parts))
            found.append(b"".join(map(self.known.__getitem__, parts)))
            if not matches:
                break
        return b"".join(found)

    def learn(self, parts: set[str]) -> None:
        if len(self.known) > REMEMBERED_PARTS:
            self.known = {}
        if new := parts.difference(self.known):
            self._learn(list(new))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, 32 bits each; an empty text has none."""
        return self.encode_escaped([SPACE + t.replace(" ", SPACE) if t else "" for t in texts])

    def encode_escaped(self, escaped: list[str]) -> list[np.ndarray]:
        """As ``encode`` for texts whose spaces are escaped, none put before them."""
        if sum(map(len, escaped)) <= HELD_PARTS:
            parts = [self.parts.findall(t) for t in escaped]
            self.learn({p for some in parts for p in some})
            return [np.frombuffer(b"".join(map(self.known.__getitem__, some)), dtype=np.int32) for some in parts]
        return [np.frombuffer(self.escaped(t), dtype=np.int32) for t in escaped]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32()))


def encode(docs: DataFrame, model_path: str, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), check: bool = True) -> DataFrame:
    """Columns ``keep`` and ``ids``, without begin and end.

    Works on Arrow batches of whole texts, in runs of about a million bytes; nothing is shuffled. With ``check`` every
    distinct part of the texts of a task is encoded by the library too, and a difference fails the query. NULL and empty
    texts have no ids. Repeated rows are encoded alike, one row each. Columns not in ``keep`` are dropped, so their names
    cannot clash; ``ids`` may not be among ``keep``. An empty table gives no rows.
    """
    schema = docs.select(*[plain(k) for k in keep]).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path, check)
        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            found = encoder.encode([t or "" for t in batch.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(found)], [*batch.schema.names[:-1], "ids"])

    return docs.select(*[plain(k) for k in keep], plain(text_column).cast("string").alias("_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, model_path: str, ids_column: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the text that the library makes of the ids.

    NULL ids give NULL, no ids an empty text. Bytes that are no characters give U+FFFD. An id outside the vocabulary
    fails. A column that is already named ``decoded`` is replaced.
    """
    others = [c for c in tokens.columns if c != output]
    schema = tokens.select(*[plain(c) for c in others]).schema.add(output, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows = part.column(ids_column).to_pylist()
                found = iter(library.decode([r for r in rows if r is not None], num_threads=1))
                texts = [None if r is None else next(found) for r in rows]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, output])

    return tokens.select(*[plain(c) for c in others]).mapInArrow(run, schema)


def digests(tokens: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of ids, SHA-256 of the ids in decimal and of the decoded text."""
    return tokens.select(
        *[plain(k) for k in keep],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
