"""Outer non-equi joins of two streams, as a changelog.

As in ``millrace.operators.joins.band_join`` the rows of one side lie in one bucket of the number line and the rows of
the other side are copied into the two buckets where they can meet partners. Each row of the first side keeps the
number of its partners in state, so it is padded with NULLs exactly while this number is 0. For a right join the sides
change places; a full join adds the padded right rows of a second pass with changed places.

What changed in a micro-batch is put in order, so that a row in state is compared with the changed rows in its band only. The
rows of a bucket are read and written in a few calls to the state store; ``bucket_width`` decides how many these are. Each
micro-batch reads the state of all buckets that it meets: where a bucket is bounded, as with unique numbers, few large
micro-batches need no more memory than many small ones, and less reading.

Inner joins need no state of their own: use ``band_join``, which takes streams as well.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.salting import NO_SALTING, Salting
from millrace.sources.changelog import DELETE, INSERT
from millrace.streaming import packs
from millrace.streaming.changelog_join import KeptRows, changed_counts, net, split

Matches = Callable[[Row, Row], bool]
# groups that rows without a key or place are dealt to
LOST_GROUPS = 2048
# places and bounds below this add up inside 64 bits
_WHOLE = 1 << 62


class _Line:
    """Changed rows with their counts, in the order of their places on the number line."""

    def __init__(self, changes: Mapping[tuple, int], at: int):
        self.rows = sorted(changes.items(), key=lambda change: change[0][at])
        self.places = [row[at] for row, _ in self.rows]

    def near(self, place, lower, upper) -> list[tuple[tuple, int]]:
        """The rows whose place less ``place`` is between ``lower`` and ``upper``."""
        first = bisect_left(self.places, lower, key=lambda p: p - place)
        return self.rows[first : bisect_right(self.places, upper, lo=first, key=lambda p: p - place)]

    def met(self, rows: Sequence[tuple], at: int, lower, upper) -> Iterator[tuple[tuple, list[tuple[tuple, int]]]]:
        """Those of ``rows`` that have rows near, with these; whole numbers are looked up all at once."""
        if not self.rows or not rows:
            return
        ours, theirs = np.array(self.places), np.array([row[at] for row in rows])
        if not all(a.dtype == np.int64 and abs(int(a.min())) < _WHOLE and abs(int(a.max())) < _WHOLE for a in (ours, theirs)) or not all(
            isinstance(bound, int) and abs(bound) < _WHOLE for bound in (lower, upper)
        ):
            yield from ((row, near) for row in rows if (near := self.near(row[at], lower, upper)))
            return
        first, last = np.searchsorted(ours, theirs + lower, "left"), np.searchsorted(ours, theirs + upper, "right")
        some = np.flatnonzero(last > first)
        for i, a, b in zip(some.tolist(), first[some].tolist(), last[some].tolist()):
            yield rows[i], self.rows[a:b]


class _CountedJoin(StatefulProcessor):
    """Rows ``one`` of a bucket with their partners among the rows ``other``; emits pairs, padded rows, or both."""

    def __init__(self, width, one, other, one_on, other_on, lower, upper, matches, pairs, ttl_ms):
        self.width, self.one, self.other = width, one, other
        self.at_one, self.at_other = one.names.index(one_on), other.names.index(other_on)
        self.lower, self.upper, self.matches, self.pairs, self.ttl_ms = lower, upper, matches, pairs, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ones = KeptRows(handle, "one", self.one, ["_n", "_partners"], self.ttl_ms)
        self.others = KeptRows(handle, "other", self.other, ["_n"], self.ttl_ms)
        self.nobody = (None,) * len(self.other)
        self.as_one, self.as_other = Row(*self.one.names), Row(*self.other.names)

    def _matched(self, one: tuple, other: tuple) -> bool:
        return self.matches is None or bool(self.matches(self.as_one(*one), self.as_other(*other)))

    def _ones_near(self, ones: _Line, others: Iterable[tuple]) -> Iterator[tuple[tuple, list[tuple[tuple, int]]]]:
        """Rows ``other`` with the changed rows ``one`` that they meet."""
        for other, near in ones.met(list(others), self.at_other, -self.upper, -self.lower):
            yield other, [(one, n) for one, n in near if self._matched(one, other)]

    def _others_near(self, others: _Line, ones: Iterable[tuple]) -> dict[tuple, list[tuple[tuple, int]]]:
        """Rows ``one`` with the changed rows ``other`` that they meet."""
        met = others.met(list(ones), self.at_one, self.lower, self.upper)
        return {one: found for one, near in met if (found := [(other, n) for other, n in near if self._matched(one, other)])}

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return packs.give(self._changes(tuple(key), packs.read_sides(rows, "one", "other")))

    def _changes(self, key: tuple, sides: dict[str, list[tuple]]) -> Iterator[tuple]:
        ids = key[: self.width]
        one_change, other_change = net(sides["one"]), net(sides["other"])

        def pair(change: int, one: tuple, other: tuple) -> Iterator[tuple]:
            if self.pairs:
                yield from pad(change, one, other)

        def pad(change: int, one: tuple, other: tuple = self.nobody) -> Iterator[tuple]:
            return repeat((INSERT if change > 0 else DELETE, *ids, *one, *other), abs(change))

        if any(v is None for v in key):
            # without a key or a place on the number line there is no partner
            for one, n in one_change.items():
                yield from pad(n, one)
            return

        one_removed, one_added = split(one_change)
        other_removed, other_added = split(other_change)

        ones, others = self.ones.load().get((), {}), self.others.load().get((), {})
        after, met, others_after = dict(ones), [], changed_counts(others, other_removed, other_added)

        if one_removed:
            line = _Line(one_removed, self.at_one)
            for other, near in self._ones_near(line, others):
                for one, n in near:
                    yield from pair(n * others[other][0], one, other)
            for one, n in one_removed.items():
                kept, partners = after.get(one, (0, 0))
                if partners == 0:
                    yield from pad(n, one)
                if kept + n > 0:
                    after[one] = (kept + n, partners)
                else:
                    after.pop(one, None)

        if other_removed or other_added:
            removed, added = _Line(other_removed, self.at_other), _Line(other_added, self.at_other)
            all_gone, all_come = self._others_near(removed, after), self._others_near(added, after)
            for one in all_gone.keys() | all_come.keys():
                (kept, partners), gone, come = after[one], all_gone.get(one, ()), all_come.get(one, ())
                now = partners + sum(n for _, n in gone) + sum(n for _, n in come)
                for other, n in gone:
                    yield from pair(n * kept, one, other)
                if (partners == 0) != (now == 0):
                    yield from pad(kept if now == 0 else -kept, one)
                for other, n in come:
                    yield from pair(n * kept, one, other)
                after[one] = (kept, now)
                met.append(one)

        if one_added:
            partners, line = dict.fromkeys(one_added, 0), _Line(one_added, self.at_one)
            for other, near in self._ones_near(line, others_after):
                for one, n in near:
                    partners[one] += others_after[other][0]
                    yield from pair(n * others_after[other][0], one, other)
            for one, n in one_added.items():
                if partners[one] == 0:
                    yield from pad(n, one)
                after[one] = (n + after.get(one, (0, 0))[0], partners[one])
        self.ones.replace((), after, one_change.keys() | met)
        self.others.replace((), others_after, other_change)
        self.ones.save(one_change)
        self.others.save(other_change)

    def close(self) -> None:
        pass


def deal_lost(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows without a key or place meet nobody, so they need not lie together: their salt is from their content alone."""
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    dealt = F.pmod(F.xxhash64(*columns), F.lit(LOST_GROUPS)).cast("int")
    return df.withColumn("_salt", F.when(lost, dealt).otherwise(F.col("_salt")))


def changelog_band_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    lower: int,
    upper: int,
    how: str = "left",
    equal: Sequence[str] = (),
    matches: Matches | None = None,
    salting: Salting = NO_SALTING,
    bucket_width: int | None = None,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Join on ``lower <= right_on - left_on <= upper``, equal columns and a test of the two rows, each if given.

    A side without ``_op`` only adds rows. The result has ``_op``, the equal columns and the other columns of both.
    Buckets are as wide as the band; where values are sparse, a larger ``bucket_width`` makes fewer groups and copies. With
    ``ttl_ms`` a row leaves the state so long after its last change (for the side that may be padded, also of the number of
    its partners); it meets nobody from then on, and nothing is reported.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    if upper < lower:
        raise ValueError("empty band")
    if how == "inner":
        raise ValueError("use band_join for an inner join")
    equal = list(equal)
    for k in equal:
        right = right.withColumn(k, F.col(k).cast(left.schema[k].dataType))

    def payload(df: DataFrame) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in (*equal, "_op")])

    left_schema, right_schema = payload(left), payload(right)
    if set(left_schema.names) & set(right_schema.names):
        raise ValueError("rename the columns that both sides have")
    columns = ["_op", *equal, *left_schema.names, *right_schema.names]
    width = F.lit(max(upper - lower, bucket_width or 1))

    def counted(one, one_schema, one_on, other, other_schema, other_on, low, high, test, pairs) -> DataFrame:
        def with_op(df: DataFrame) -> DataFrame:
            return df if "_op" in df.columns else df.withColumn("_op", F.lit(INSERT))

        def packed(df: DataFrame, side: str, schema: T.StructType) -> DataFrame:
            return packs.pack(df, [*keys, "_salt"], ["_op", schema.names], side)

        keys = [*equal, "_bucket"]
        placed = with_op(one).withColumn("_bucket", F.floor(F.col(one_on) / width))
        first, last = F.floor((F.col(other_on) - F.lit(high)) / width), F.floor((F.col(other_on) - F.lit(low)) / width)
        copied = with_op(other).withColumn("_bucket", F.explode(F.sequence(first, last)))
        content = [*equal, *one_schema.names]
        ones = deal_lost(salting.spread(placed, keys, content), keys, content)
        others = salting.copy(copied.dropna(subset=keys), keys)
        changes = packed(ones, "one", one_schema).unionByName(packed(others, "other", other_schema))
        key_fields = [T.StructField(k, left.schema[k].dataType) for k in equal]
        output = T.StructType([T.StructField("_op", T.StringType()), *key_fields, *one_schema.fields, *other_schema.fields])
        processor = _CountedJoin(len(equal), one_schema, other_schema, one_on, other_on, low, high, test, pairs, ttl_ms)
        joined = changes.groupBy(*keys, "_salt").transformWithState(
            processor, packs.packed_schema(), "append", "ProcessingTime" if ttl_ms else "None"
        )
        return packs.unpack(joined, output).select(*columns)

    turned = (lambda one, other: matches(other, one)) if matches is not None else None
    from_left = (left, left_schema, left_on, right, right_schema, right_on, lower, upper, matches)
    from_right = (right, right_schema, right_on, left, left_schema, left_on, -upper, -lower, turned)
    if how == "left":
        return counted(*from_left, True)
    if how == "right":
        return counted(*from_right, True)
    return counted(*from_left, True).unionByName(counted(*from_right, False))
