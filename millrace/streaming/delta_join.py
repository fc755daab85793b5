"""Joins of two streams whose rows may be changed later, micro-batch by micro-batch in DataFrames.

The result is a changelog. Rows of both sides are kept with their number and with how many of them stand padded in the
result. A micro-batch joins its changes with the kept rows of the other side and touches the keys that it names, nothing
else: changed left rows meet the right rows of now, changed right rows the left rows of before. A row without partner is
padded with NULLs; the padded row is removed as soon as a partner comes. The net of all output is the join of the current
rows.

What is kept lies in files next to the checkpoint (``millrace.streaming.kept``). Nothing is held in Python; joins are plain
ones, so that adaptive execution splits hot keys.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.changelog import DELETE, INSERT
from millrace.streaming.kept import KeptRows
from millrace.streaming.runner import AVAILABLE_NOW

def _added_up(columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Changes of rows as one row each: how many there are, how many of them stand padded, and the last touch."""

    def fold(changes: DataFrame) -> DataFrame:
        return changes.groupBy(*columns).agg(
            F.sum("_n").alias("_n"), F.sum("_padded").alias("_padded"), F.max("_at").alias("_at")
        ).where("_n > 0")

    return fold


def _signed(change: Column) -> Column:
    return F.when(change > 0, F.lit(INSERT)).otherwise(F.lit(DELETE))


def start_changelog_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    path: str,
    checkpoint: str,
    how: str = "left",
    ttl_seconds: float | None = None,
    buckets: int = 64,
    trigger: dict | None = None,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Inner, left, right or full join on equal keys; each micro-batch is written to ``batch=<id>`` below ``path``.

    A side without ``_op`` only adds rows. The result has ``_op``, the keys and the other columns of both sides, whose
    names must differ. With ``ttl_seconds`` a row that was neither changed nor met by a change of the other side for that
    long is forgotten: it meets no later row, nothing is reported, and it leaves the files when their changes are next folded
    (every ``kept.FOLDED`` micro-batches, also if its key never comes again). A row that had partners does not become padded by
    their expiry, and so is not un-padded when the next one comes. Rows of a NULL key never meet any. The kept rows lie in
    ``buckets`` parts, of which a micro-batch reads those of its keys; the number belongs to the checkpoint.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    keys = list(on)
    for k in keys:
        right = right.withColumn(k, F.col(k).cast(left.schema[k].dataType))

    def sides(df: DataFrame) -> T.StructType:
        own = [f for f in df.schema.fields if f.name not in (*keys, "_op")]
        return T.StructType([*[left.schema[k] for k in keys], *own])

    schemas = {"l": sides(left), "r": sides(right)}
    if set(schemas["l"].names) & set(schemas["r"].names) - set(keys):
        raise ValueError("rename the columns that both sides have")

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return (df if "_op" in df.columns else df.withColumn("_op", F.lit(INSERT))).withColumn("_side", F.lit(side))

    changes = tagged(left, "l").unionByName(tagged(right, "r"), allowMissingColumns=True)
    numbers = [T.StructField(n, T.LongType()) for n in ("_n", "_padded", "_at")]
    kept = {
        side: KeptRows(f"{checkpoint}-kept/{side}", keys, T.StructType([*schema.fields, *numbers]), _added_up(schema.names), buckets)
        for side, schema in schemas.items()
    }
    pads = {"l": how in ("left", "full"), "r": how in ("right", "full")}
    columns = [*keys, *schemas["l"].names[len(keys) :], *schemas["r"].names[len(keys) :]]
    joinable = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])

    def save(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        # switched off for the stream itself, of use for its bounded parts
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        now = int(clock() * 1000)
        alive = None if ttl_seconds is None else F.col("_at") >= now - int(ttl_seconds * 1000)
        sign = F.when(F.col("_op") == INSERT, F.lit(1)).otherwise(F.lit(-1)).cast("long")
        rows = rows.persist()
        touched = rows.where(joinable).select(*keys).distinct().persist()

        def side(name: str) -> DataFrame:
            """Rows of the touched keys: ``_n`` of them before and ``_dn`` more now."""
            own, schema = kept[name], schemas[name]
            new = rows.where(F.col("_side") == name).select(
                *schema.names, F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_padded"),
                F.lit(now).cast("long").alias("_at"), sign.alias("_dn"),
            )
            old = own.before(touched, batch_id, alive).withColumn("_dn", F.lit(0).cast("long"))
            found = new.unionByName(old).groupBy(*schema.names).agg(
                F.sum("_n").alias("_n"), F.sum("_padded").alias("_padded"), F.sum("_dn").alias("_dn"),
                F.max(F.when(F.col("_dn") == 0, F.col("_at"))).alias("_at"),
            )
            found = found.withColumns({"_stored": F.col("_n"), "_stored_padded": F.col("_padded")})
            if alive is not None:
                # what is forgotten counts as never seen
                found = found.withColumns({c: F.when(alive, F.col(c)).otherwise(F.lit(0).cast("long")) for c in ("_n", "_padded")})
            # a row that is not there cannot go; rows of a NULL key are not kept
            found = found.withColumn("_dn", F.when(joinable, F.greatest(F.col("_dn"), -F.col("_n"))).otherwise(F.col("_dn")))
            return found.where("_n != 0 OR _dn != 0").persist()

        one = {name: side(name) for name in ("l", "r")}

        def of_key(name: str) -> DataFrame:
            """What a row says of its key: rows of its side before and now, and whether it has changed."""
            mine = {"_before": F.col("_n"), "_now": F.col("_n") + F.col("_dn"), "_moved": (F.col("_dn") != 0).cast("long")}
            zero = F.lit(0).cast("long")
            return one[name].where(joinable).select(
                *keys, *[(value if s == name else zero).alias(f"{c}_{s}") for s in ("l", "r") for c, value in mine.items()]
            )

        # counted once a micro-batch; both sides look at the other's numbers
        counted = of_key("l").unionByName(of_key("r"))
        counts = counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counted.columns if c not in keys]).persist()

        def judged(name: str, other: str) -> DataFrame:
            """The rows of a side with the other side's numbers of their key and the change ``_dp`` of how many stand padded."""
            seen = {f"_{c}": F.coalesce(f"_{c}_{other}", F.lit(0)) for c in ("before", "now", "moved")}
            found = one[name].join(counts, keys, "left").select(*one[name].columns, *[value.alias(c) for c, value in seen.items()])
            after = F.col("_n") + F.col("_dn")
            padded = (
                F.when(F.col("_now") > 0, F.lit(0)).when(F.col("_before") > 0, after)
                .otherwise(F.greatest(F.lit(0), F.col("_padded") + F.col("_dn")))
                if pads[name] else F.lit(0)
            )
            padding = F.when(joinable, padded.cast("long") - F.col("_padded")).otherwise(F.col("_dn") if pads[name] else F.lit(0))
            return found.withColumn("_dp", padding).persist()

        both = {"l": judged("l", "r"), "r": judged("r", "l")}

        def pairs(a: DataFrame, b: DataFrame, change: Column) -> DataFrame:
            joined = a.alias("a").join(b.alias("b"), keys).withColumn("_change", change)
            return joined.where("_change != 0").select(*columns, "_change")

        # only rows whose key has something for them on the other side are dealt by their keys
        results = [
            pairs(
                both["l"].where("_dn != 0 AND _now != 0"), both["r"].where("_n + _dn != 0 AND _moved != 0"),
                F.col("a._dn") * (F.col("b._n") + F.col("b._dn")),
            ),
            pairs(
                both["l"].where("_n != 0 AND _moved != 0"), both["r"].where("_dn != 0 AND _before != 0"), F.col("a._n") * F.col("b._dn")
            ),
        ]
        for name, rows_ in both.items():
            if pads[name]:
                results.append(rows_.where("_dp != 0").select(*schemas[name].names, F.col("_dp").alias("_change")))
            moved = (F.col("_dn") != 0) | (F.col("_dp") != 0)
            if alive is not None:
                moved = moved | (F.col("_moved") != 0)
            # as changes to what is stored: of a forgotten row that comes again the old number is taken back
            written = rows_.where(moved & joinable).select(
                *schemas[name].names,
                (F.col("_n") + F.col("_dn") - F.col("_stored")).alias("_n"),
                (F.col("_padded") + F.col("_dp") - F.col("_stored_padded")).alias("_padded"),
                F.lit(now).cast("long").alias("_at"),
            )
            kept[name].write(written, batch_id)
        net = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), results)
        out = net.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_change"))))
        out.select(_signed(F.col("_change")).alias("_op"), *columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for df in (*both.values(), counts, *one.values(), touched, rows):
            df.unpersist()

    writer = changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
