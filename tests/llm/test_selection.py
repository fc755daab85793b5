"""Quality rules and mixing."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, quality
from millrace.llm.common import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels)
    assert 0 < len(model.rules) < 100 and all(" if " in line for line in model.text())
    rows = quality.scored(docs, model).withColumn("held", quality.is_held_out()).join(labels, "doc_id").filter("held").collect()
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95


def test_compiled_rules_score_as_the_model(spark):
    docs = table(spark, SF, "documents").limit(50)
    model = quality.RuleModel(0.25, ((((0, True, 4.0), (1, False, 0.8)), 1.5), (((4, True, 0.0),), -2.0)))
    held = quality.with_statistics(docs).select("doc_id", *quality.STATISTICS).toPandas().set_index("doc_id")
    for row in quality.scored(docs, model).select("doc_id", "score").collect():
        s = held.loc[row.doc_id]
        odds = 0.25 + 1.5 * (s["_q_words"] > 4 and s["_q_distinct"] <= 0.8) - 2.0 * (s["_q_exclaims"] > 0)
        assert row.score == pytest.approx(1 / (1 + math.exp(-odds)))


def test_odd_texts_and_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, "c"), (2, "", "c"), (None, "good text here", "c"), (3, "!! " * 50_000, "c"), (3, "!! " * 50_000, "c")],
        "doc_id bigint, text string, score string",
    )
    for labels in ([], [(1, 1), (None, 0), (2, None)], [(1, 0), (2, 1), (3, 1), (3, 0)]):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
        rows = quality.scored(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    kept = quality.keep_good(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert kept.columns == docs.columns and kept.count() == 5  # no labels: nothing speaks against a text
    assert quality.scored(docs.limit(0), model).count() == 0


def test_lasso_finds_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 2] <= 0.5)).astype(float)
    model = quality.fit_rules(x, y)
    odds = model.intercept + sum(w * quality._holds(x, r) for r, w in model.rules)
    assert ((odds > 0) == (y == 1)).mean() > 0.97


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    below = p
    while below < u:
        k += 1
        p *= mean / k
        below += p
    return k


def test_mix_by_hand(spark):
    import hashlib

    rows = [(i, f"s{0 if i % 3 else i % 7}", f"t{i}") for i in range(600)] + [(1000, None, None), (None, "s0", "n"), (5, "s0", "t5")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("rate", F.lit("own"))
    got = mixing.mix(docs, temperature=0.0, epochs=2.0)
    assert got.columns == ["doc_id", "source", "text", "rate", "copy"]
    counts = Counter(s for _, s, _ in rows)
    expected = Counter()
    for i, s, t in rows:
        rate = 2.0 * len(rows) / len(counts) / counts[s]
        parts = math.ceil(rate / mixing.LARGEST_MEAN)
        n = 0
        for part in range(1, parts + 1):
            row = [str(i) if i is not None else "\x01", s or "\x01", t or "\x01", "own"]
            name = hashlib.md5("\x1f".join(row).encode()).hexdigest()
            u = (int(hashlib.md5(f"42:{name}:{part}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            n += poisson(rate / parts, u)
        expected.update((i, s, t, c) for c in range(n))
    assert Counter((r.doc_id, r.source, r.text, r.copy) for r in got.collect()) == expected


def test_rows_without_ids_draw_by_themselves(spark):
    docs = spark.createDataFrame([(None, "a", f"t{i}") for i in range(1000)] + [(7, "a", f"u{i}") for i in range(1000)], "doc_id bigint, source string, text string")
    copies = Counter(r.text for r in mixing.mix(docs, epochs=1.0).collect())
    assert 0.3 < (2000 - len(copies)) / 2000 < 0.44 and 1800 < sum(copies.values()) < 2200  # exp(-1) of them draw none
    parts = mixing.mix(docs).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 1200


def test_weights_and_rates(spark):
    docs = spark.createDataFrame([(i, "a" if i < 900 else "b") for i in range(1000)], "doc_id bigint, source string")
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights={"a": 1.0, "b": 3.0, "c": 5.0}).collect()}
    assert rates == pytest.approx({"a": 250 / 900, "b": 7.5})
    mixed = Counter(r.source for r in mixing.mix(docs, weights={"a": 1.0, "b": 3.0}).collect())
    assert 200 < mixed["a"] < 300 and 650 < mixed["b"] < 850
    assert set(r.source for r in mixing.mix(docs, weights={"b": 1.0}).collect()) == {"b"}
    assert mixing.mix(docs, weights={"c": 1.0}).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_is_native_and_shuffled(spark):
    docs = spark.createDataFrame([(i, "a") for i in range(3000)], "doc_id bigint, source string")
    mixed = mixing.mix(docs)
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    order = [r.doc_id for r in mixed.collect()]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.1
