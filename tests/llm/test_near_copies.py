"""The near-copy stage of the pipeline against brute force over five-word shingles."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import nearcopies
from millrace.llm.common import SCHEMAS


def similar(a, b):
    def cut(text):
        words = (text or "").lower().split()
        size = min(5, len(words))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()

    x, y = cut(a), cut(b)
    return len(x & y) * 10 >= 8 * len(x | y)


def kept_by_hand(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if similar(a, b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i for i, _ in rows if root(i) == i}


def planted():
    """Texts and their edited copies: words changed, dropped and moved, just above and below the limit."""
    rng = random.Random(5)
    words = [f"w{n}" for n in range(3000)]
    rows = [(1, None), (2, " \t"), (3, "one"), (4, "One"), (5, "one two")]
    for n in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([40, 120, 400, 1500]))]
        copy = list(base)
        for at in rng.sample(range(len(copy)), max(1, len(copy) * (n % 5) // 100)):
            copy[at] = "changed"
        rows += [(100 + 10 * n, " ".join(base)), (101 + 10 * n, " ".join(copy))]
        rows += [(102 + 10 * n, " ".join(base[len(base) * (n % 30) // 100 :]))]
    return rows


def test_planted_near_copies_go(spark):
    rows = planted()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMAS["documents"])
    after = corpus_pipeline.near_copies(spark, docs, "")
    assert after.columns == docs.columns
    left, expected = {r.doc_id for r in after.collect()}, kept_by_hand(rows)
    assert expected <= left and len(left - expected) <= (len(rows) - len(expected)) // 50
    assert len(expected) < len(rows) - 60


def test_dense_groups_chains_and_parts(spark):
    base = [f"b{n}" for n in range(300)]
    rows = [(n, " ".join(base[n * 8 :] + [f"n{n}x{k}" for k in range(n * 8)])) for n in range(12)]  # each like the next only
    rows += [(100 + n, " ".join([*base[:150], f"own{n}", *base[150:]])) for n in range(50)]
    rows += [(200, rows[3][1] + " x")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMAS["documents"])
    assert {r.doc_id for r in nearcopies.drop_near_copies(docs).collect()} == kept_by_hand(rows)
    fps = nearcopies._prints(docs, "doc_id", "text").selectExpr("node", "fp", "size", "sketch", "node AS label").cache()
    whole = {frozenset(r) for r in nearcopies.candidates(fps).collect()}
    assert whole == {frozenset(r) for r in nearcopies.candidates(fps, tile_rows=3).collect()} and len(whole) > 1000


def test_rows_with_repeated_or_missing_ids(spark):
    text = " ".join(f"w{n}" for n in range(80))
    rows = [(1, text), (2, text + " more"), (2, "quite another text"), (None, text), (3, text[:-4]), (5, "v " + text.replace("w", "v")), (5, text.replace("w", "v"))]
    rows += [(None, "z " + text.replace("w", "z")), (None, text.replace("w", "z"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = [r.doc_id for r in nearcopies.drop_near_copies(docs.filter("text != '' AND NOT (doc_id IS NULL AND text LIKE 'w%')")).collect()]
    assert sorted(left, key=str) == [1, 2, 5, None]


def edited_group(count, words, changed, seed=3):
    """Texts that differ from one and the same text in ``changed`` words each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    rows = []
    for n in range(count):
        copy = list(base)
        for at in rng.sample(range(words), changed):
            copy[at] = f"x{n}y{at}"
        rows.append((n, " ".join(copy)))
    return rows


def test_unlike_texts_of_a_group_never_become_pairs(spark):
    docs = spark.createDataFrame(edited_group(600, 400, 12), "doc_id bigint, text string")
    nodes = nearcopies._prints(docs, "doc_id", "text").selectExpr("node", "fp", "size", "sketch", "node AS label")
    assert nearcopies.candidates(nodes).count() < 600 * 600 // 2 // 25
    assert nearcopies.candidates(nodes, give="nearest").distinct().count() <= 600 * 2
    assert nearcopies.drop_near_copies(docs).count() == 600


def test_links_of_sets_in_small_parts(spark):
    rows = [r for r in planted() if similar(r[1], r[1])][:120] + [(1000 + i, t) for i, t in edited_group(60, 100, 1)] + [(2000 + i, t) for i, t in edited_group(60, 100, 3, seed=4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    nodes = nearcopies._prints(docs, "doc_id", "text").dropDuplicates(["node"]).withColumn("label", F.col("node"))
    sets = nodes.join(nearcopies._sets(nodes, docs, "text"), "node").select("node", "size", "label", "shingles").cache()
    ids = {r.node: r.id for r in nodes.collect()}
    for tile_shingles in (200, 3000, 1 << 21):
        links = [(ids[r.u], ids[r.v]) for r in nearcopies.similar_links(sets, tile_shingles).collect()]
        text = dict(rows)
        assert all(similar(text[u], text[v]) for u, v in links)
        if tile_shingles == 1 << 21:
            assert len(links) < 2 * len(rows)
        parent = {i: i for i in ids.values()}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in links:
            x, y = sorted((root(u), root(v)))
            parent[y] = x
        assert {i for i in parent if root(i) == i} == kept_by_hand([(i, text[i]) for i in sorted(parent)])


def test_pairs_just_above_the_limit_are_found(spark):
    """Three changed words of 150 leave 0.81; half of the pairs are long texts with nine of 440."""
    rows, expected = [], 0
    for n in range(150):
        size, changed = ((150, 3), (440, 9))[n % 2]
        (_, a), (_, b) = edited_group(2, size, 0, seed=n)
        words = b.split()
        for at in range(changed):
            words[(at * size) // changed + 2] = f"new{n}x{at}"
        rows += [(2 * n, a), (2 * n + 1, " ".join(words))]
        expected += similar(a, rows[-1][1])
    assert expected >= 140
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    dropped = len(rows) - nearcopies.drop_near_copies(docs).count()
    assert expected * 0.97 <= dropped <= expected


def test_sketches_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(8)
    apart = []
    for _ in range(60):
        both, own = rng.integers(0, 1 << 62, 800), rng.integers(0, 1 << 62, (2, 100))
        a, b = (np.frombuffer(nearcopies.sketch(np.unique(np.concatenate([both, o]))), np.uint8) for o in own)
        apart.append(int(np.bitwise_count(a ^ b).sum()))
    assert 22 < np.mean(apart) < 29 and max(apart) <= nearcopies.SKETCH_RADIUS  # 25.6 for 800 of 1000 in common
    assert nearcopies.sketch(np.zeros(0, np.int64)) == nearcopies.sketch(np.zeros(0, np.int64))
