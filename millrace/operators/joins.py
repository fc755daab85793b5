"""Regular joins on bounded tables and streams.

No side is broadcast by hint. Spark broadcasts a side when its size, estimated or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled on the key and adaptive execution splits
partitions that a hot key makes too big. ``salting`` spreads hot keys of the left side up front, for plans that
adaptive execution cannot change (streams, full outer joins).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.salting import NO_SALTING, Salting

HOWS = ("inner", "left", "right", "full")


def _disjoint(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    common = set(left.columns) & set(right.columns) - set(on)
    if common:
        raise ValueError(f"rename the columns that both sides have: {sorted(common)}")


def _on(keys: Sequence[str], condition: Column | None) -> Column:
    terms = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in keys]
    if condition is not None:
        terms.append(condition)
    return reduce(lambda a, b: a & b, terms)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, condition: Column | None) -> DataFrame:
    """Equality on the keys plus a residual condition; the keys come out once."""
    if condition is None:
        return left.join(right, list(keys), how)
    joined = left.alias("_l").join(right.alias("_r"), _on(keys, condition), how)
    if how in ("left_semi", "left_anti"):
        return joined
    merged = [
        (F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}")) if how == "full" else F.col(f"_r.{k}" if how == "right" else f"_l.{k}")).alias(k)
        for k in keys
    ]
    rest = [F.col(c) for c in [*left.columns, *right.columns] if c not in keys]
    return joined.select(*merged, *rest)


def regular_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    salting: Salting = NO_SALTING,
) -> DataFrame:
    """Inner, left, right or full join on equal keys, with an optional further condition on the other columns.

    With ``salting`` the left rows of a hot key are spread over groups and its right rows are copied into each.
    Unmatched right rows cannot be seen inside one group, so they come from a separate anti-join.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}")
    if not on:
        raise ValueError("no equal keys: use band_join")
    _disjoint(left, right, on)
    keys = list(on)
    columns = [*keys, *[c for c in [*left.columns, *right.columns] if c not in keys]]
    if salting.idle:
        return _join(left, right, keys, how, condition).select(*columns)

    salted = salting.spread(left, keys, left.columns)
    copies = salting.copy(right, keys)
    matched = _join(salted, copies, [*keys, "_salt"], "left" if how in ("left", "full") else "inner", condition)
    matched = matched.select(*columns)
    if how in ("inner", "left"):
        return matched

    # one row per key is enough to know which right rows have a partner, unless the other columns matter
    partners = left.select(*keys).distinct() if condition is None else left
    alone = _join(
        salting.spread(right, keys, right.columns), salting.copy(partners, keys), [*keys, "_salt"], "left_anti", condition
    )
    return matched.unionByName(alone.select(*keys, *[c for c in right.columns if c not in keys]), allowMissingColumns=True)


def band_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    lower: int,
    upper: int,
    how: str = "inner",
    equal: Sequence[str] = (),
    condition: Column | None = None,
    salting: Salting = NO_SALTING,
) -> DataFrame:
    """Non-equi join: ``lower <= right_on - left_on <= upper``, plus equal columns and a further condition if given.

    The number line is cut into buckets at least as wide as the band. A left row lies in one bucket and a right row
    can only meet left rows of two neighbouring buckets, so it is copied into these. The join is then an equi-join on
    the bucket and compares near rows only, never all pairs of the two tables. ``salting`` spreads buckets further.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}")
    if upper < lower:
        raise ValueError("empty band")
    _disjoint(left, right, equal)
    columns = [*equal, *[c for c in [*left.columns, *right.columns] if c not in equal]]
    keys = [*equal, "_bucket", "_salt"]
    band = F.col(f"_r.{right_on}") - F.col(f"_l.{left_on}")
    inside = band.between(lower, upper)
    if condition is not None:
        inside = inside & condition

    width = F.lit(max(upper - lower, 1))

    def one_bucket(df: DataFrame, column: str) -> DataFrame:
        placed = df.withColumn("_bucket", F.floor(F.col(column) / width))
        return salting.spread(placed, [*equal, "_bucket"], df.columns)

    def near_buckets(df: DataFrame, column: str, back: int, ahead: int) -> DataFrame:
        first = F.floor((F.col(column) - F.lit(back)) / width)
        last = F.floor((F.col(column) - F.lit(ahead)) / width)
        return salting.copy(df.withColumn("_bucket", F.explode(F.sequence(first, last))), [*equal, "_bucket"])

    if how == "right":
        matched = None
    else:
        matched = _join(
            one_bucket(left, left_on),
            near_buckets(right, right_on, upper, lower),
            keys,
            "left" if how in ("left", "full") else "inner",
            inside,
        ).select(*columns)
    if how in ("inner", "left"):
        return matched

    # seen from the right side the band is mirrored: -upper <= left_on - right_on <= -lower
    right_cells, left_cells = one_bucket(right, right_on), near_buckets(left, left_on, -lower, -upper)
    right_cells, left_cells = right_cells.alias("_r"), left_cells.alias("_l")
    if how == "right":
        joined = right_cells.join(left_cells, _on(keys, inside), "left")
        picked = [F.col(f"_r.{c}") if c in equal or c in right.columns else F.col(f"_l.{c}") for c in columns]
        return joined.select(*[p.alias(c) for p, c in zip(picked, columns)])
    alone = right_cells.join(left_cells, _on(keys, inside), "left_anti").drop("_bucket", "_salt")
    return matched.unionByName(alone, allowMissingColumns=True)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    order: Sequence[str],
    columns: Sequence[str],
    salting: Salting = NO_SALTING,
) -> DataFrame:
    """Add dimension columns; exactly one row per input row, NULL on a miss, the last duplicate by ``order`` wins.

    Duplicates are resolved by an aggregate that is combined before the shuffle. The dimension is loaded once per
    query and broadcast by Spark if its measured size allows it; if not, ``salting`` spreads the rows of hot keys.
    """
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("_last")
    unique = dim.where(F.col(key).isNotNull()).groupBy(key).agg(last).select(key, "_last.*")
    if salting.idle:
        return df.join(unique, key, "left").select(*df.columns, *columns)
    spread = salting.spread(df, [key], df.columns)
    return spread.join(salting.copy(unique, [key]), [key, "_salt"], "left").select(*df.columns, *columns)


def interval_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, lower: str, upper: str, how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Join of rows with equal keys whose times lie in a band: ``left_ts + lower <= right_ts <= left_ts + upper``.

    Takes tables and streams. On streams with watermarks (``windows.with_watermark`` on both) this is Spark's own join: its
    state holds a row until no partner in the band can come any more, and an outer join gives the padded row then. Rows only
    arrive; for streams that change rows see ``millrace.streaming.changelog_band``.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    if not on:
        raise ValueError("no equal keys: use band_join")
    _disjoint(left, right, on)

    def shifted(interval: str) -> Column:
        return F.col(f"_l.{left_ts}") + F.expr(f"INTERVAL {interval}")

    near = F.col(f"_r.{right_ts}").between(shifted(lower), shifted(upper))
    same = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in on]
    for further in [near] if condition is None else [near, condition]:
        same.append(further)
    joined = left.alias("_l").join(right.alias("_r"), reduce(Column.__and__, same), how)
    keys = [(F.coalesce(F.col(f"_l.{k}"), F.col(f"_r.{k}"))).alias(k) for k in on]
    return joined.select(*keys, *[F.col(c) for c in [*left.columns, *right.columns] if c not in on])
