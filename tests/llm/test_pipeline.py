"""The pipeline against its parts done by hand, on the smallest tables."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import exactdedup, mixing, quality
from millrace.llm.common import table
from tests.llm.test_duplicates import exact_by_hand
from tests.llm.test_near_copies import kept_by_hand

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    model = quality.fit(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r for r in quality.scored(docs, model).filter("score >= 0.7").collect()}
    after = corpus_pipeline.good_quality(spark, docs, SF)
    assert after.columns == docs.columns and {r.doc_id for r in after.collect()} == set(rows)
    kept = {r[0] for r in exact_by_hand([(i, r.text) for i, r in rows.items()]) if r[3]}
    after = corpus_pipeline.exact_copies(spark, after, SF)
    assert after.columns == docs.columns and {r.doc_id for r in after.collect()} == kept
    unique = kept_by_hand([(i, rows[i].text) for i in sorted(kept)])
    after = corpus_pipeline.near_copies(spark, after, SF)
    assert after.columns == docs.columns and {r.doc_id for r in after.collect()} == unique
    mixed = corpus_pipeline.mixed(spark, after, SF)
    assert mixed.columns == docs.columns
    expected = Counter(r.doc_id for r in mixing.mix(after).collect())
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in final) == expected and set(expected) <= unique
    assert all(r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest() for r in final)


def test_empty_and_odd_documents(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5)],
        table(spark, SF, "documents").schema,
    )
    for start in (docs, docs.limit(0)):
        rows = start
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
        assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "streamed_sha256"]
        # an empty text and "a b c" at most, as often as they are drawn
        assert {r.n_tokens for r in rows.collect()} <= ({0, 3} if start is docs else set())
    # each stage by itself keeps what it should
    assert sorted(r.text or "" for r in corpus_pipeline.exact_copies(spark, docs, SF).collect()) == ["", "a b c"]
    near = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text) for r in near if r.doc_id) == [(1, None), (3, "a b c"), (3, "a b c")] and len(near) == 3
    tokens = corpus_pipeline.token_ids(spark, docs, SF).collect()
    assert sorted(r.n_tokens for r in tokens) == [0, 0, 3, 3, 3]
    empty = hashlib.sha256(b"").hexdigest()
    assert all({r.decoded_sha256, r.streamed_sha256, r.offsets_sha256} == {empty} for r in tokens if not r.n_tokens)
    assert corpus_pipeline.mixed(spark, docs, SF).columns == docs.columns


def test_clashing_columns_pass_through(spark):
    docs = table(spark, SF, "documents").limit(60)
    extra = ["score", "dropped_id", "kept_id", "kept_sha", "_q_words", "_q_text", "_q_row", "_mix_n", "_mix_row", "id", "fp", "rate", "a.b"]
    for name in extra:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, SF)
        assert rows.columns == docs.columns
        found = rows.collect()
        assert found and all(r[name] == f"{name}{r.doc_id}" for r in found for name in extra)
    assert exactdedup.drop_exact_duplicates(docs.union(docs)).count() == exactdedup.drop_exact_duplicates(docs).count()
