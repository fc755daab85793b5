"""Byte-level BPE: encoding with byte and character offsets, and decoding of whole or streamed ids."""

from __future__ import annotations

import array
import codecs
import hashlib
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import in_chunks, plain

# Pieces of text whose ids a task remembers; the memory is emptied when it is full, which changes no result.
REMEMBERED_PIECES = 200_000
# New pieces that go to the library at a time, and bytes of text that a task splits at a time.
NEW_PIECES, TEXT_BYTES = 5_000, 1_000_000
# Pieces of one text that are held at a time.
HELD_PIECES = 500_000


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary, inverted.

    Printable Latin-1 bytes stand for themselves; the others take the characters from U+0100 on, in order.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


def token_bytes(vocabulary_path: str) -> dict[int, bytes]:
    """Bytes of each id of a tokenizer file."""
    with open(vocabulary_path, encoding="utf-8") as file:
        content = json.load(file)
    inverse = byte_characters()
    found = {i: bytes(inverse[c] for c in token) for token, i in content["model"]["vocab"].items() if all(c in inverse for c in token)}
    return found | {t["id"]: t["content"].encode() for t in content["added_tokens"]}


class Encoder:
    """Encodes texts with the tokenizers library, each match of ``pattern`` separately and once per task.

    The pieces of a text are looked up in what the task has seen; new ones go to the library in batches. Strings of special
    tokens are ordinary text.
    """

    def __init__(self, vocabulary_path: str, pattern: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.pattern = regex.compile(pattern)
        self.tokenizer = Tokenizer.from_file(vocabulary_path)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The matches of a text; those of a very long one part by part."""
        if len(text) <= HELD_PIECES:
            yield self.pattern.findall(text)
            return
        matches = (match.group() for match in self.pattern.finditer(text))
        while part := list(itertools.islice(matches, HELD_PIECES)):
            yield part

    def learn(self, pieces: set[str]) -> None:
        """Let the library encode the pieces that are not known yet, many in one call."""
        if len(self.known) > REMEMBERED_PIECES:
            self.known = {}
        new = list(pieces.difference(self.known))
        for begin in range(0, len(new), NEW_PIECES):
            part = new[begin : begin + NEW_PIECES]
            for piece, encoding in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[piece] = array.array("i", encoding.ids).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, 32 bits each."""
        found = []
        if sum(map(len, texts)) <= 4 * HELD_PIECES:
            split = [self.pattern.findall(text) for text in texts]
            self.learn({p for pieces in split for p in pieces})
            found = [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]
        else:
            for text in texts:
                parts = []
                for pieces in self._pieces(text):
                    self.learn(set(pieces))
                    parts.append(b"".join(map(self.known.__getitem__, pieces)))
                found.append(b"".join(parts))
        return [np.frombuffer(ids, dtype=np.int32) for ids in found]


def character_offsets(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of tokens that take ``lengths`` bytes each, one after the other.

    A token that begins or ends inside a character counts that character as its own.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    starts_character = (raw & 0xC0) != 0x80
    number = np.cumsum(starts_character) - 1  # the character of each byte
    ends = np.cumsum(lengths)
    begins = ends - lengths
    return number[begins], number[ends - 1] + 1


class Decoder:
    """Bytes and text of ids, by the table of the bytes of each id."""

    def __init__(self, vocabulary_path: str):
        table = token_bytes(vocabulary_path)
        self.size = np.zeros(max(table) + 1, dtype=np.int64)
        for i, token in table.items():
            self.size[i] = len(token)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(table.get(i, b"") for i in range(len(self.size))), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.size) and self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.size[ids]
        # a byte's place in the table: its token's place, and how far into the token it is
        shift = np.repeat(self.begin[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes()

    def streamed(self, ids: np.ndarray, run: int) -> Iterator[str]:
        """Text of ids that come ``run`` at a time: bytes of a character that a run splits wait for the next run."""
        decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
        for begin in range(0, len(ids), run):
            yield decoder.decode(self.joined(ids[begin : begin + run]))
        yield decoder.decode(b"", final=True)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, vocabulary_path: str, pattern: str, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",),
    offsets: bool = True,
) -> DataFrame:
    """Columns ``keep`` and ``ids``; with ``offsets`` also ``starts`` and ``ends``, in characters of the text.

    Works on Arrow batches of whole texts, in runs of a few million characters; nothing is shuffled. NULL and empty
    texts have no ids. Repeated rows are encoded alike, one row each. Columns not in ``keep`` are dropped, so their
    names cannot clash; ``ids``, ``starts`` and ``ends`` may not be among ``keep``.
    """
    schema = docs.select(*[plain(k) for k in keep]).schema.add("ids", T.ArrayType(T.IntegerType()))
    if offsets:
        schema = schema.add("starts", T.ArrayType(T.IntegerType())).add("ends", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary_path, pattern)
        table = token_bytes(vocabulary_path)
        size = np.zeros(max(table) + 1, dtype=np.int64)
        for i, token in table.items():
            size[i] = len(token)
        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            found = encoder.encode(texts)
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [_lists(found)]
            names = [*batch.schema.names[:-1], "ids"]
            if offsets:
                pairs = [character_offsets(t.encode(), size[ids]) for t, ids in zip(texts, found)]
                columns += [_lists([p[side] for p in pairs]) for side in (0, 1)]
                names += ["starts", "ends"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*[plain(k) for k in keep], plain(text_column).cast("string").alias("_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary_path: str, ids_column: str = "ids", output: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the bytes of the ids one after the other.

    Bytes are returned, since ids cut anywhere may begin or end inside a character; ``decode_stream`` makes text of
    them. NULL ids give NULL, no ids give no bytes. An id outside the vocabulary fails. A column that is already named
    ``decoded`` is replaced.
    """
    others = [c for c in tokens.columns if c != output]
    schema = tokens.select(*[plain(c) for c in others]).schema.add(output, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                column = part.column(ids_column)
                texts = [None if not row.is_valid else decoder.joined(row.values.to_numpy(zero_copy_only=False)) for row in column]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, output])

    return tokens.select(*[plain(c) for c in others]).mapInArrow(run, schema)


def decode_stream(ids, table: dict[int, bytes]) -> Iterator[str]:
    """Text of ids that come one by one: bytes of an incomplete character wait for the next id, broken ones give U+FFFD."""
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    for i in ids:
        if text := decoder.decode(table[i]):
            yield text
    if text := decoder.decode(b"", final=True):
        yield text


def digests(tokens: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Number of ids, SHA-256 of the ids in decimal and of the decoded bytes."""
    return tokens.select(
        *[plain(k) for k in keep],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def round_trip(
    docs: DataFrame, vocabulary_path: str, pattern: str, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",), run_ids: int = 256,
) -> DataFrame:
    """Columns ``keep`` and digests of what encoding and decoding every text gives, without the ids leaving their task.

    ``n_tokens``, ``ids_sha256`` (ids in decimal, joined by spaces), ``decoded_sha256`` (bytes of the ids), ``offsets_sha256``
    (first characters and then end characters of the tokens, as little-endian 32-bit numbers) and ``streamed_sha256`` (text
    of the ids when they come ``run_ids`` at a time and may split characters). NULL texts are empty and repeated rows
    alike, as in ``encode``; columns not in ``keep`` are dropped; an empty table gives no rows.
    """
    names = ("ids_sha256", "decoded_sha256", "offsets_sha256", "streamed_sha256")
    kept = docs.select(*[plain(k) for k in keep]).schema.fields
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), *[T.StructField(n, T.StringType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary_path, pattern), Decoder(vocabulary_path)
        decimal = list(map(str, range(len(decoder.size))))
        for batch in in_chunks(batches, "_text", TEXT_BYTES):
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            rows = []
            for text, ids in zip(texts, encoder.encode(texts)):
                starts, ends = character_offsets(text.encode(), decoder.size[ids])
                streamed = hashlib.sha256()
                for part in decoder.streamed(ids, run_ids):
                    streamed.update(part.encode())
                rows.append((
                    len(ids), hashlib.sha256(" ".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest(),
                    hashlib.sha256(decoder.joined(ids)).hexdigest(),
                    hashlib.sha256(starts.astype("<i4").tobytes() + ends.astype("<i4").tobytes()).hexdigest(), streamed.hexdigest(),
                ))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), *[pa.string()] * 4))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], schema.names)

    return docs.select(*[plain(k) for k in keep], plain(text_column).cast("string").alias("_text")).mapInArrow(run, schema)
