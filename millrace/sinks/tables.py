"""Append and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.jdbc import read_table


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The target after the updates: the last update of a key by ``order`` replaces or adds its row.

    The updates are reduced to one row per key by an aggregate that is combined before the shuffle, so a key with very
    many updates does no harm, and the target is only anti-joined with these keys. NULL keys are not allowed.
    """
    columns = [c for c in target.columns if c not in keys]
    rank = F.struct(*order) if order else F.struct(*columns)
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*columns), rank).alias("_last")).select(*keys, "_last.*")
    untouched = target.join(last.select(*keys), list(keys), "left_anti")
    return untouched.select(*target.columns).unionByName(last.select(*target.columns))


def append_table(df: DataFrame, options: dict[str, str]) -> None:
    """Append rows to a database table without a key."""
    df.write.format("jdbc").options(**options).mode("append").save()


def upsert_table(
    updates: DataFrame, options: dict[str, str], keys: Sequence[str], split: dict[str, str], order: Sequence[str] = (),
    staging_suffix: str = "_staging",
) -> str:
    """Write the image of a keyed database table after the updates to a staging table; gives its name.

    ``split`` cuts the scan of the table into tasks, see ``read_table``. The table that is read is never overwritten. Exchange the two tables in the database afterwards.
    """
    target = read_table(updates.sparkSession, options, split)
    staging = options["dbtable"] + staging_suffix
    image = upsert(target, updates, keys, order)
    image.write.format("jdbc").options(**{**options, "dbtable": staging}).mode("overwrite").save()
    return staging
