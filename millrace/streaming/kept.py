"""What a stream keeps between micro-batches, in files next to its checkpoint.

A micro-batch writes what it changes, cut by a hash of the key; every few micro-batches the changes are folded into one
table. A micro-batch reads the parts of the keys that it names. One that is repeated after a failure reads what its first
run read and writes over what that wrote, for the files that it reads are kept until it is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# micro-batches whose changes are folded at a time
FOLDED = 8


class KeptRows:
    """Rows with ``keys``; ``fold`` makes one table of the changes of several micro-batches."""

    def __init__(self, path: str, keys: Sequence[str], schema: T.StructType, fold: Callable[[DataFrame], DataFrame], buckets: int):
        self.path, self.keys, self.fold, self.buckets = path, list(keys), fold, buckets
        self.stored = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _base(self, batch_id: int) -> str:
        return f"{self.path}/base={batch_id // FOLDED % 2}"

    def _changes(self, batch_id: int) -> str:
        return f"{self.path}/changes={batch_id % (2 * FOLDED)}"

    def _read(self, spark, paths: list[str]) -> DataFrame:
        frames = [spark.read.schema(self.stored).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], self.stored)

    def _paths(self, start: int, batch_id: int) -> list[str]:
        return ([self._base(start)] if start else []) + [self._changes(b) for b in range(start, batch_id)]

    def before(self, touched: DataFrame, batch_id: int, alive: Column | None = None) -> DataFrame:
        """What was kept of the keys ``touched`` before a micro-batch, as changes that ``fold`` adds up.

        Rows that are not ``alive`` when changes are folded leave the files, whichever keys the micro-batch names.
        """
        spark = touched.sparkSession
        start = batch_id - batch_id % FOLDED
        if batch_id and batch_id == start:
            folded = self.fold(self._read(spark, self._paths(start - FOLDED, batch_id)))
            if alive is not None:
                folded = folded.where(alive)
            self._save(folded.drop("_bucket"), self._base(batch_id))
        named = touched.select(self.bucket().alias("_bucket"), *[F.col(k).alias(f"_touched_{k}") for k in self.keys])
        numbers = [r[0] for r in named.select("_bucket").distinct().collect()]  # the number of buckets at most
        rows = self._read(spark, self._paths(start, batch_id)).where(F.col("_bucket").isin(numbers))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_touched_{k}")) for k in self.keys])
        return rows.drop("_bucket").join(named.drop("_bucket"), same, "left_semi")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        self._save(changes, self._changes(batch_id))

    def _save(self, rows: DataFrame, path: str) -> None:
        placed = rows.withColumn("_bucket", self.bucket())
        placed.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(path)
