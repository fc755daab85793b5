"""Byte-level BPE against the rank library, round trips, offsets."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe
from millrace.llm.queries import vocabulary

TEXTS = [
    "", None, " ", "Hello, world's  end\n\n", "\u00e9t\u00e9 \u4f60\u597d \U0001f600\U0001f468\u200d\U0001f469 \u0301", "a" * 3000, "  \t\n x", "<|endoftext|> </s>",
    "123456 78,9 ab12", "\x00\x01\x7f\x85\xa0\u3000", "it's we'll I'D", "\ufffd\ufeff",
]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id int, text string, ids string")


def test_ids_and_round_trip(spark, reference):
    path, pattern = vocabulary()
    rows = bpe.decode(bpe.encode(frame(spark, TEXTS * 2), path, pattern), path).collect()
    assert len(rows) == 2 * len(TEXTS)
    for row in rows:
        text = TEXTS[row.doc_id % len(TEXTS)] or ""
        assert row.ids == reference.encode_ordinary(text)
        assert bytes(row.decoded).decode() == text
        # the tokens' characters cover the text, and each holds its token's bytes
        for i, begin, end in zip(row.ids, row.starts, row.ends):
            assert reference.decode_single_token_bytes(i) in text[begin:end].encode()
        assert not row.ids or (row.starts[0] == 0 and row.ends[-1] == len(text))


def test_every_character_is_split_alike(reference):
    path, pattern = vocabulary()
    encoder = bpe.Encoder(path, pattern)
    texts = ["".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}!" for c in range(b, b + 64) if not 0xD800 <= c < 0xE000) for b in range(0, 0x32000, 64)]
    assert [i.tolist() for i in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_table_holds_the_ranks(ranks):
    table = bpe.token_bytes(vocabulary()[0])
    assert {table[r]: r for r in ranks.values()} == ranks


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 3)
    monkeypatch.setattr(bpe, "HELD_PIECES", 2)
    encoder = bpe.Encoder(*vocabulary())
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        assert [encoder.encode([t])[0].tolist() for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_streamed_ids_with_split_characters():
    table = bpe.token_bytes(vocabulary()[0])
    ids = bpe.Encoder(*vocabulary()).encode(["x\U0001f468\u200d\U0001f469\u4f60"])[0].tolist()
    assert any(b"\x80" <= table[i][:1] < b"\xc0" for i in ids)  # some id begins inside a character
    assert "".join(bpe.decode_stream(ids, table)) == "x\U0001f468\u200d\U0001f469\u4f60"
    assert "".join(bpe.decode_stream(ids[:2], table)).startswith("x")


def test_digests_and_empty_table(spark, reference):
    path, pattern = vocabulary()
    rows = bpe.digests(bpe.decode(bpe.encode(frame(spark, TEXTS), path, pattern, offsets=False), path)).collect()
    for row in rows:
        ids = reference.encode_ordinary(TEXTS[row.doc_id] or "")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256((TEXTS[row.doc_id] or "").encode()).hexdigest()
    assert bpe.decode(bpe.encode(frame(spark, []), path, pattern), path).count() == 0


def test_offsets_of_bytes():
    begins, ends = bpe.character_offsets("a\u00e9\U0001f600".encode(), np.array([1, 1, 1, 3, 1]))
    assert begins.tolist() == [0, 1, 1, 2, 2] and ends.tolist() == [1, 2, 2, 3, 3]


def test_round_trip_digests(spark, reference):
    path, pattern = vocabulary()
    for run_ids in (1, 3, 256):
        found = {r.doc_id: r for r in bpe.round_trip(frame(spark, TEXTS), path, pattern, run_ids=run_ids).collect()}
        listed = {r.doc_id: r for r in bpe.encode(frame(spark, TEXTS), path, pattern).collect()}
        for i, text in enumerate(TEXTS):
            ids, whole = reference.encode_ordinary(text or ""), hashlib.sha256((text or "").encode()).hexdigest()
            offsets = np.array([*listed[i].starts, *listed[i].ends], dtype="<i4").tobytes()
            assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
            assert (found[i].decoded_sha256, found[i].streamed_sha256) == (whole, whole)
            assert found[i].offsets_sha256 == hashlib.sha256(offsets).hexdigest()
    assert bpe.round_trip(frame(spark, TEXTS).limit(0), path, pattern).count() == 0
