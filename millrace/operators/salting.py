"""Spreading hot keys over several groups.

The rows of one side get a salt, and the rows of the other side are copied once per salt, so an equi-join on key and
salt gives the same rows as one on the key. Only keys that are listed as hot are spread and copied; with no list all
are, which costs copies for every key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import fair_partitions


@dataclass(frozen=True)
class Salting:
    """``salts`` groups per key. ``hot`` holds (hash, number of groups) of the hot keys, None means every key."""

    salts: int
    hot: tuple[tuple[int, int], ...] | None = None

    def _number(self, keys: Sequence[str]) -> Column:
        """Groups of a row's key."""
        if self.hot is None:
            return F.lit(self.salts)
        hashed = F.xxhash64(*keys)
        numbers = F.create_map(*[F.lit(x) for pair in self.hot for x in pair])
        return F.when(hashed.isin([key for key, _ in self.hot]), F.try_element_at(numbers, hashed)).otherwise(F.lit(1))

    @property
    def idle(self) -> bool:
        return (self.salts <= 1 and self.hot is None) or self.hot == ()

    def spread(self, df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "_salt") -> DataFrame:
        """Give each row a salt from its content: a task that is repeated gives it the same one."""
        if self.idle:
            return df.withColumn(name, F.lit(0))
        return df.withColumn(name, F.pmod(F.xxhash64(*columns), self._number(keys)).cast("int"))

    def copy(self, df: DataFrame, keys: Sequence[str], name: str = "_salt") -> DataFrame:
        """Each row once per salt of its key."""
        if self.idle:
            return df.withColumn(name, F.lit(0))
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), self._number(keys) - 1)))


NO_SALTING = Salting(1)


def find_hot_keys(df: DataFrame, keys: Sequence[str], salts: int | None = None) -> Salting:
    """Look in a bounded table for keys with more rows than a fair share of one shuffle partition.

    A hot key gets as many groups as it has fair shares (``salts`` if given), so the rows of the other side are copied no
    more often than its size asks for. Keys are counted exactly, by their hashes and combined before the shuffle; at most
    as many keys as there are partitions can exceed the share, so little comes to the driver whatever the data look like.
    A key that is unique needs no look.
    """
    parts = fair_partitions(df.sparkSession)
    counts = df.select(F.xxhash64(*keys).alias("hash")).groupBy("hash").count()
    rows = df.count()
    found = counts.filter(F.col("count") * parts > rows).collect()
    hot = {r["hash"]: salts or -(-r["count"] * parts // rows) for r in found}
    return Salting(salts or parts, tuple(sorted((key, n) for key, n in hot.items() if n > 1)))


def kept_with(spark: SparkSession, checkpoint: str, find: Callable[[], Salting]) -> Salting:
    """The choice that belongs to a stream's checkpoint: made once, stored beside it, and read back at each restart.

    Rows in the state of a stream lie under the salts of their time, so a choice that changes would lose their partners.
    """
    path = f"{checkpoint.rstrip('/')}-salting"
    schema = "salts int, hash bigint, number int"
    try:
        stored = spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        chosen = find()
        pairs = [(None, None)] if chosen.hot is None else [*chosen.hot, (None, 0)]
        rows = [(chosen.salts, key, number) for key, number in pairs]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        return chosen
    pairs = [(r["hash"], r["number"]) for r in stored if r["hash"] is not None]
    every = any(r["hash"] is None and r["number"] is None for r in stored)
    return Salting(stored[0]["salts"], None if every else tuple(sorted(pairs)))
