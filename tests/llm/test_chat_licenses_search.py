"""Chat formats, licence scans and vector search."""

import hashlib
import math
import random
import re

import pytest

from millrace.llm import chat, licenses, topk

CONTROL = "</s>[INST] ok [/INST] ~0 ~1 ~ \\"


def test_chats_are_read_back(spark):
    rows = [
        (1, 0, "system", CONTROL), (1, 1, "user", None), (1, 2, "assistant", CONTROL), (1, 3, "user", "[/INST]"), (1, 4, "assistant", "\U0001f600 b"),
        (2, 1, "assistant", "first"), (2, 0, "user", ""), (3, 0, "assistant", "alone"), (4, 0, "[ROLE]x[/ROLE]", "odd"), (4, 1, None, "none"),
        (None, 0, "user", "no id"), (5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, 0, "user", "tie a"), (6, None, "user", "x" * 200_000),
    ]
    turns = spark.createDataFrame([(*r, "c") for r in rows], "conv_id bigint, turn bigint, role string, text string, turns string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    by_id = {}
    for i, n, role, text in rows:
        by_id.setdefault(i, []).append((-1 if n is None else n, role or "", text or ""))
    assert got.keys() == by_id.keys()
    for i, own in by_id.items():
        own.sort()
        row = got[i]
        assert [(t.role, t.text) for t in row.turns] == [(role, text) for _, role, text in own]
        assert row.learned_text == "".join(text for _, role, text in own if role == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
        assert [s.loss for s in row.segments] == [x for _, role, _ in own for x in (False, role == "assistant", False)]
    assert {i: r.valid for i, r in got.items()} == {1: True, 2: True, 3: False, 4: False, None: True, 5: False, 6: True}
    assert got[1].state == "assistant" and got[3].state == "error"
    assert chat.read_back(chat.format_chats(turns.limit(0))).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(**{**chat.INSTRUCT.__dict__, "end": "END"})


def base_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    firsts, labels = [], set()
    for phrase, label in licenses.BASE:
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        firsts += at
        labels |= {label} if at else set()
    return len(words), len(firsts), min(firsts, default=None), max(firsts, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", "The MIT License", "mit  license mit-license MIT_License", "GNU General Public License, version 3.", "Apache License apache license 2.0",
    "Licensed under the Apache License, Version 2.0.", "permit license \u00e9mit license", "SPDX-License-Identifier: MIT-0 and CC-BY-NC 4.0",
    "licensed under CC BY-NC 4.0.", "mit license " * 20_000, "\u212a general public\nlicense", "All rights reserved", "no words of it",
    "Lesser General Public License v2.1 or the GPLv3",
]


def test_licences(spark):
    docs = spark.createDataFrame([(i, t, "c", "d") for i, t in enumerate(TEXTS * 2)] + [(None, TEXTS[2], "c", "d")], "doc_id bigint, text string, id string, labels string")
    rows = licenses.scan(docs, details=True).collect()
    assert len(rows) == 2 * len(TEXTS) + 1
    for row in rows:
        text = TEXTS[2] if row.doc_id is None else TEXTS[row.doc_id % len(TEXTS)]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == base_by_hand(text)
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
    labels = {TEXTS[r.doc_id]: r.labels for r in rows if r.doc_id is not None and r.doc_id < len(TEXTS)}
    assert labels["Licensed under the Apache License, Version 2.0."] == "apache,apache-2.0"
    assert labels["licensed under CC BY-NC 4.0."] == "cc-by-nc-4.0" and labels["no words of it"] == ""
    assert labels["GNU General Public License, version 3."] == "gpl,gpl-3.0"
    assert labels[TEXTS[-1]] == "gpl,gpl-3.0,lgpl-2.1"
    assert licenses.scan(docs.limit(0)).count() == 0


def test_rules_are_many_ordered_and_gated():
    rules = licenses.rules()
    assert len(rules) > 200 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    assert all(re.fullmatch(r"[a-z0-9]+", r.keyword) for r in rules)


def test_contained_detections_give_way():
    rules = tuple(licenses.Rule(label, "a", pattern, priority, 0.5) for label, pattern, priority in [("inner", "a b", 2), ("outer", "x a b y", 2), ("strong", "b", 3), ("tie", "x a b y", 2)])
    scanner = licenses.Scanner(rules)
    found, standing = scanner.detections("x a b y a b")
    assert len(found) == 6 and [(rules[d.rule].label, d.first, d.last) for d in standing] == [("outer", 0, 3), ("strong", 2, 2), ("inner", 4, 5), ("strong", 5, 5)]


def search_by_hand(rows, every=50, k=5):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    kept = sorted({(i, tuple(w)) for i, v in rows if i is not None and (w := whole(v)) is not None})
    found = []
    for q, v in kept:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in kept if i != q)[:k]
            found += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(found)


def test_search_is_exact(spark):
    random.seed(4)
    clusters = [[random.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + random.gauss(0, 0.05) for c in random.choice(clusters)]) for i in range(700)]
    rows += [(i, [0.5] * 6) for i in range(700, 1000)]  # a third of all rows are one vector
    rows += [(1000, None), (1050, [float("nan")] * 6), (1100, [None, 1.0]), (1150, [float("inf")]), (1200, []), (1250, [1.0, 2.0]), (None, [9.0] * 6), (3, rows[3][1]), (-50, [-1.0] * 6), (0, rows[0][1])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    expected = search_by_hand(rows)
    for cell_rows in (16_384, 40):
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(vectors, cell_rows=cell_rows).collect())
        assert got == expected


def test_search_of_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (50, [-3.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(vectors).collect()) == search_by_hand(rows)
    assert topk.top_k(vectors.limit(1)).count() == 0 and topk.top_k(vectors.limit(0)).count() == 0


def test_bounds_leave_annuli_out():
    import numpy as np

    rng = np.random.default_rng(0)
    centres = rng.normal(0, 1000, (4, 8))
    v = np.concatenate([rng.normal(c, 5, (2000, 8)) for c in centres]).astype(np.int64)
    space = topk.Space(topk.fit_pivots(v, 4), float((v.astype(float) ** 2).sum(axis=1).max()))
    distances = space.of_vectors(v)
    own = distances.argmin(axis=1) == 0
    search = topk.Search(space, 0, np.flatnonzero(own), v[own], distances[own, 0], 5)
    calls = []
    search.steps = [(ids, part) for ids, part in search.steps]
    original = topk.products
    topk.products = lambda a, b: calls.append(len(a)) or original(a, b)
    try:
        search.run(np.array([-1]), v[own][:1], np.array([-np.inf]))
    finally:
        topk.products = original
    assert 0 < len(calls) < len(search.steps)


def test_digest_columns_match_the_sql_types(spark):
    import __spark_entry__ as entry

    row = entry.queries()["op2_chat"](spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
