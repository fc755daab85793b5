"""Exact and near duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import components, exactdedup, simhash

SCHEMA = "doc_id bigint, text string, id string, norm string, digest string, fp string, kept string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", None, "z", "k") for i, t in rows], SCHEMA)


DOCS = [
    (5, "a  b\tc"), (3, "a b c"), (9, " a b c"), (4, None), (8, ""), (7, "\x0b "), (2, " "), (11, "a\u00a0b c"),
    (6, "A b c"), (3, "a b c"), (None, "lonely"), (None, "a b c"), (20, "x" * 300_000), (21, "x" * 300_000), (22, "x" * 300_001),
]


def exact_by_hand(rows):
    import hashlib
    import re

    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    found = []
    for (i, _), n in zip(rows, norm):
        same = [j for (j, _), m in zip(rows, norm) if m == n]
        keep = min((j for j in same if j is not None), default=None)
        found.append((i, keep, len(same), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("digest", [F.md5, lambda text: F.substring(F.md5(text), 1, 1), lambda text: F.lit("same")])
def test_exact_with_collisions(spark, digest):
    got = exactdedup.exact_duplicates(frame(spark, DOCS), digest=digest).collect()
    assert sorted((tuple(r) for r in got), key=str) == exact_by_hand(DOCS)


def test_exact_empty(spark):
    assert exactdedup.exact_duplicates(frame(spark, [])).count() == 0
    assert exactdedup.drop_exact_duplicates(frame(spark, [])).count() == 0


def test_exact_stage_keeps_one_row(spark):
    unique = [(i, t) for i, t in DOCS if i is not None]
    got = exactdedup.drop_exact_duplicates(frame(spark, unique))
    assert got.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 3, 4, 6, 9, 11, 20, 22]
    once = [(i, t) for n, (i, t) in enumerate(unique) if (i, t) not in unique[:n]]
    assert sorted(r.doc_id for r in exactdedup.drop_exact_duplicates(frame(spark, once)).collect()) == [2, 3, 4, 6, 9, 11, 20, 22]


def fingerprint_by_hand(text):
    import re

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components_by_hand(fps, radius=2):
    """Index of the first member of each one's component."""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def test_near_duplicates(spark):
    random.seed(1)
    base = [random.choice("alpha beta Gamma delta \u00c9t\u00e9 zeta".split()) + str(random.randrange(30)) for _ in range(400)]
    rows = [(100 + i, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for i, k in enumerate(range(0, 400, 7))]
    rows += [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "One"), (6, "one two"), (7, "\u00c9"), (8, "\u00e9"), (9, "a" * 200_000)]
    rows += [(100, rows[0][1]), (50, rows[3][1]), (None, rows[4][1])]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    fps = [fingerprint_by_hand(t) for _, t in rows]
    at = components_by_hand(fps)
    least = {c: min(i for (i, _), d in zip(rows, at) if d == c and i is not None) for c in set(at)}
    expected = [(i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, at)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    kept = simhash.drop_near_duplicates(frame(spark, [r for r in rows if r[0] != 100])).columns
    assert kept == frame(spark, []).columns
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_links_of_dense_groups_and_split_tiles(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(centres.tolist()) | {0, 2**64 - 1, 2**63}
    for c in centres[:10].tolist():
        fps |= {c ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)}
    fps |= {c ^ 1 ^ 2 ^ 4 for c in centres[20:30].tolist()}
    ordered = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in ordered]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    expected = components_by_hand(ordered)
    for tile_rows in (4096, 3):
        links = simhash.near_links(df, tile_rows=tile_rows)
        found = {r.node: r.label for r in components.components(links).collect()}
        labels = [found.get(f, f) for f in signed]
        groups = {}
        for label, e in zip(labels, expected):
            groups.setdefault(e, set()).add(label)
        assert all(len(g) == 1 for g in groups.values()) and len(set(labels)) == len(set(expected))


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 201), (201, 200), (-5, 200)]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {-5: -5, 200: -5, 201: -5}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_exact_stage_keeps_one_row_of_repeated_or_missing_ids(spark):
    rows = [(1, "a b", "x"), (1, "a  b", "y"), (1, "a b", "x"), (2, "a b", "x"), (None, "c", "x"), (None, "c", "y"), (None, " c", "y"), (3, "d", "x"), (None, "d", "x"), (4, None, "x"), (4, "", "y")]
    found = exactdedup.drop_exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    left = found.collect()
    assert sorted(((r.doc_id, (r.text or "").replace("  ", " ")) for r in left), key=str) == [(1, "a b"), (3, "d"), (4, ""), (None, " c"), (None, "c")]
    again = exactdedup.drop_exact_duplicates(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, source string"))
    assert found.columns == again.columns and {tuple(r) for r in left} == {tuple(r) for r in again.collect()}
