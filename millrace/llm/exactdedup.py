"""Exact duplicates: 128-bit content hash, smallest id, byte comparison inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import free_name, plain, text_of, written

# Runs of these characters count as one space.
SPACES = r"[\x20\x09-\x0D]+"


def one_space(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Rows are grouped by ``digest`` (128 bits) and, inside a digest, by the bytes of the normalised text, so texts that
    merely collide are told apart. The grouping is an aggregate: each task first folds its copies into one row, so a
    group that holds a third of all rows reaches the shuffle as one row per task, and a text crosses it once per task.
    The answer goes back to the rows over the digest and SHA-256, without the texts; a skewed digest is split by
    adaptive execution.

    NULL texts are empty texts, and empty texts equal each other. Rows repeated with the same id get the same answer
    (all ``kept`` or none). A NULL id is larger than any other; in a group of NULL ids only, ``keep_id`` is NULL and all
    rows are kept. Other columns of ``docs`` play no part. An empty table gives an empty result.
    """
    texts = docs.select(plain(id_column).alias("id"), one_space(text_of(text_column)).alias("norm"))
    classes = (
        texts.select("id", digest(F.col("norm")).alias("digest"), "norm")
        .groupBy("digest", "norm")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    classes = written(
        classes.select("digest", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"), "exact-classes"
    )
    rows = texts.select("id", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("sha"))
    return rows.join(classes.hint("merge"), ["digest", "sha"]).select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Of each group of equal texts one row stays: that with the smallest id and, of several with this id, the one whose other
    columns have the smallest hash. The latter takes a further shuffle, so it is done only if some id occurs twice.
    """
    answer = exact_duplicates(docs, id_column, text_column).select(plain(id_column).alias("id"), "kept")
    answer = written(answer, "exact-answer")
    if not answer.groupBy("id").count().filter("count > 1").isEmpty():
        return _drop_by_text(docs, id_column, text_column)
    name = free_name(docs, "dropped_id")
    dropped = answer.filter(~F.col("kept")).select(F.col("id").alias(name))
    return docs.join(dropped.hint("merge"), plain(id_column).eqNullSafe(F.col(name)), "left_anti")


def _drop_by_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per text, for tables whose ids are not unique or missing."""
    sha, rank, least = (free_name(docs, name) for name in ("kept_sha", "kept_rank", "kept_least"))
    ranked = docs.withColumn(sha, F.sha2(one_space(text_of(text_column)), 256)).withColumn(
        rank,
        F.struct(plain(id_column).isNull().alias("without"), plain(id_column).alias("id"), F.xxhash64(*map(plain, docs.columns)).alias("hash")),
    )
    first = ranked.groupBy(sha).agg(F.min(rank).alias(least))
    first = written(first.select(F.col(sha).alias(sha + "_"), least), "exact-first")
    stay = ranked.join(first.hint("merge"), (F.col(sha) == F.col(sha + "_")) & F.col(rank).eqNullSafe(F.col(least)), "left_semi")
    # what is left of a text is one row, as often as it is repeated whole
    return stay.dropDuplicates([sha]).drop(sha, rank)
