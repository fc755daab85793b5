"""Tables, text helpers and written intermediate results of the training-data operators."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_folder

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Characters of text that one step of a Python task holds at a time.
CHUNK_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and outlives lost executors."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns of a row in one, so that no column made beside it can clash with their names."""
    return F.struct(*[plain(c) for c in df.columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str) -> Column:
    """Text with NULL as empty."""
    return F.coalesce(plain(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def in_chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``limit`` bytes in ``column``; one larger row stays whole."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        begin = size = 0
        for row, more in enumerate(sizes):
            if row > begin and size + more > limit:
                yield batch.slice(begin, row - begin)
                begin, size = row, 0
            size += int(more)
        if begin < len(sizes):
            yield batch.slice(begin)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
