"""Piece BPE against the sentencepiece library; tokenizer alignment against a walk over the tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment, bpe, piecebpe
from millrace.llm.common import table
from millrace.llm.queries import QUERIES, piece_vocabulary, vocabulary

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", None, " ", "   ", "Hello, world's  end\n\n", "été 你好 \U0001f600\U0001f468‍\U0001f469 ́", "a" * 3000, "  \t\n x",
    "<|endoftext|> </s> <0x41><s>", "123456 78,9 ab12", "\x00\x01\x7f\x85\xa0　", "it's we'll I'D 'stop x'stop", "�﻿",
    "here ▁ stands▁a mark", "a;\r\nb \r c", "x². ½ y²", "हिन्दी में", "the " * 500, "x" + " " * 400 + "y",
]
PIECES = ["a", "s", "T", " ", "  ", "\n", "\t", "'", "'s", "'ll", " 's", "é", "中", "́", "　", "\U0001f600", "\x1c", "\x85", "हि", ",", ".", "!", "12", "²", "\r", "▁", "the", "ing", "</s>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary())


@pytest.fixture(scope="module")
def byte_level():
    tokenizer = Tokenizer.from_file(vocabulary()[0])
    tokenizer.encode_special_tokens = True
    table_a = bpe.token_bytes(vocabulary()[0])
    return tokenizer, [table_a.get(i, b"") for i in range(max(table_a) + 1)]


def random_texts(count, seed=5, size=25):
    rng = random.Random(seed)
    for n in range(count):
        some = PIECES if n % 3 else [p for p in PIECES if p not in ("\r", "▁", "́", "हि", "²")]
        yield "".join(rng.choice(some) for _ in range(rng.randint(0, size)))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "c", "d") for i, t in enumerate(texts)], "doc_id int, text string, ids string, decoded string")


def test_ids_and_text_of_pieces(spark, library):
    docs = frame(spark, TEXTS * 2)
    rows = piecebpe.decode(piecebpe.encode(docs, piece_vocabulary()), piece_vocabulary()).collect()
    assert len(rows) == 2 * len(TEXTS)
    for row in rows:
        expected = library.encode(TEXTS[row.doc_id % len(TEXTS)] or "")
        assert row.ids == expected and row.decoded == library.decode(expected)
    assert piecebpe.encode(docs.limit(0), piece_vocabulary()).count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [230, 131])], "doc_id int, ids array<int>")
    assert [r.decoded for r in piecebpe.decode(ids, piece_vocabulary()).orderBy("doc_id").collect()] == [None, "", library.decode([230, 131])]


def test_agenda_equals_the_library(library):
    encoder, long = piecebpe.Encoder(piece_vocabulary()), piecebpe.Encoder(piece_vocabulary())
    texts = [t for t in TEXTS if t] + list(random_texts(4000))
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text)
    for text in texts[:600]:
        if text:  # one agenda for the whole text, without parts
            assert long._long(piecebpe.SPACE + text.replace(" ", piecebpe.SPACE)).tolist() == library.encode(text)


def test_long_text_in_parts(library, monkeypatch):
    monkeypatch.setattr(piecebpe, "HELD_PARTS", 50)
    monkeypatch.setattr(piecebpe, "REMEMBERED_PARTS", 100)
    text = " ".join(random_texts(200, seed=7))
    assert piecebpe.Encoder(piece_vocabulary()).encode([text])[0].tolist() == library.encode(text)


def test_check_finds_a_difference(monkeypatch):
    encoder = piecebpe.Encoder(piece_vocabulary())
    merged = encoder.agenda.many
    monkeypatch.setattr(encoder.agenda, "many", lambda texts: (merged(texts)[0] + 1, merged(texts)[1]))
    with pytest.raises(ValueError, match="differ"):
        encoder.encode(["some words"])


def test_other_vocabularies_are_refused_or_whole(library):
    agenda = piecebpe.Agenda({"ab": -1.0, "bc": -0.5, "abc": -3.0, "a b": -2.0}, {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5, " ": 6, "a b": 7})
    assert agenda.one("abcab") == ["abc", "ab"] and agenda.one("") == []
    symbols, counts = agenda.many(["abcab", "x", "abab", "cc"])
    assert symbols.tolist() == [5, 3, agenda.size + ord("x"), 3, 3, 2, 2] and counts.tolist() == [2, 1, 2, 2]
    assert agenda.many([])[1].tolist() == []


def test_query_of_pieces(spark, library):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op11_piece_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def aligned_by_hand(texts, byte_level, library):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest, n_overlaps) of each text."""
    tokenizer, table_a = byte_level
    table_b = [
        bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()
        for i in range(library.get_piece_size())
    ]
    found = []
    for text in texts:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        raw = (" " + text).encode() if text else b""
        if b"".join(table_a[i] for i in a) != raw or b"".join(table_b[i] for i in b) != raw:
            a = b = []
        ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((table_a, a), (table_b, b)))
        names, links, i, j = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            own_a, own_b = [], []
            while i < len(a) and ends_a[i] <= end:
                own_a.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= end:
                own_b.append(b[j])
                j += 1
            names.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
            links.update((x, y) for x in own_a for y in own_b)
        # two cuts of the same bytes overlap in as many pairs as there are pieces of the common cut
        overlaps = len(set(ends_a) | set(ends_b))
        digest = hashlib.sha256(";".join(names).encode()).hexdigest() if a else ""
        found.append((len(a), len(b), len(names), links, digest, overlaps))
    holds, most = Counter(), defaultdict(int)
    for f in found:
        holds.update(f[3].keys())
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    return [
        (
            n_a, n_b, n_groups, sum(links.values()), sum(n for p, n in links.items() if holds[p] == most[p[0]]),
            sum(n * holds[p] for p, n in links.items()), digest, overlaps,
        )
        for n_a, n_b, n_groups, links, digest, overlaps in found
    ]


def aligned(df):
    return {
        r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.n_overlaps) for r in df.collect()
    }


def test_alignment_of_odd_and_random_texts(spark, byte_level, library, monkeypatch):
    texts = [t or "" for t in TEXTS * 2] + list(random_texts(500, seed=9, size=40))
    docs = frame(spark, TEXTS * 2 + texts[2 * len(TEXTS) :]).repartition(5)
    expected = dict(enumerate(aligned_by_hand(texts, byte_level, library)))
    assert aligned(alignment.align_tokenizers(docs, *vocabulary(), piece_vocabulary())) == expected
    # small blocks, rows and memories; long texts part by part
    for name, value in {
        "BLOCK_PAIRS": 40, "ROW_PAIRS": 8, "TEXT_BYTES": 300, "HELD_SEGMENTS": 30, "REMEMBERED": 50, "EXPANDED": 64, "NEW_SEGMENTS": 7
    }.items():
        monkeypatch.setattr(alignment, name, value)
    assert aligned(alignment.align_tokenizers(docs, *vocabulary(), piece_vocabulary(), check=True)) == expected


def test_alignment_keeps_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a word", "x"), (1, None, "y"), (1, "a word", "z")], "doc_id int, text string, `_block` string")
    df = alignment.align_tokenizers(docs, *vocabulary(), piece_vocabulary(), keep=("doc_id", "_block"))
    rows = {r["_block"]: r for r in df.collect()}
    assert df.columns[:2] == ["doc_id", "_block"] and rows["x"].doc_id is None
    assert (rows["x"].n_links, rows["x"].count_sum, rows["x"].n_best) == (2, 4, 2) and rows["y"].groups_sha256 == ""
    assert alignment.align_tokenizers(docs.limit(0), *vocabulary(), piece_vocabulary()).count() == 0


def test_query_of_alignment(spark, byte_level, library):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    expected = dict(zip(docs, aligned_by_hand(docs.values(), byte_level, library)))
    assert aligned(QUERIES["op12_alignment"](spark, SF)) == expected


def test_products_of_matrices(monkeypatch):
    rng = np.random.default_rng(4)
    for limit in (1, 50, 1 << 20):
        monkeypatch.setattr(alignment, "EXPANDED", limit)
        a, b = (rng.random(s) < 0.3 for s in ((9, 7), (7, 11)))
        a[3] = False

        def sparse(m):
            return alignment.Matrix(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1])

        found = np.zeros((9, 11), dtype=int)
        for row, column, value in alignment.product(sparse(a), sparse(b)):
            found[row, column] += value
        assert (found == a.astype(int) @ b.astype(int)).all()
        turned = sparse(a).transposed()
        assert (turned.starts == sparse(a.T).starts).all() and (turned.columns == sparse(a.T).columns).all()
