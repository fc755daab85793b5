"""Joins of two streams whose rows may be changed later; the result is a changelog.

Rows of both sides are kept in state with their multiplicity. A new or removed row gives the joined rows that appear
or disappear; a row of an outer side without partner is padded with NULLs, and the padded row is removed as soon as a
partner comes. At any time the net of all output equals the join of the current rows.

The left rows of a hot key are spread over groups by their content, and the right rows of that key are copied into
each group. Padding of left rows is decided inside a group, since each group sees all right rows of its
key. Whether a right row has any left partner cannot be seen inside one group; for that a second stage counts, per key,
the groups that hold left rows. Groups report only when they become filled or empty.

Within a micro-batch the changes of a group are netted first, then removals are applied before insertions.

A call to the state store costs far more than a row in it, so keys share groups: they are dealt to cells by their hash, and a
group reads and writes its rows in a few calls. Rows lie under their keys, so that a change looks at the rows of its keys only.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import repeat

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.salting import NO_SALTING, Salting
from millrace.sources.changelog import DELETE, INSERT
from millrace.streaming import packs

# groups that the keys are dealt to
CELLS = 2048
# kinds of rows that the second stage looks at
_OCCUPANCY, _RIGHT = "occupancy", "right"


def _sign(op: str) -> int:
    return 1 if op == INSERT else -1


def net(changes: Iterable[tuple[str, tuple]]) -> dict[tuple, int]:
    """How many of each row come, or go if negative."""
    counts: dict[tuple, int] = {}
    for op, row in changes:
        counts[row] = counts.get(row, 0) + _sign(op)
    return counts


def _net_by_key(changes: Iterable[tuple[str, tuple, tuple]]) -> dict[tuple, dict[tuple, int]]:
    """``net`` of the rows of each key."""
    by_key: dict[tuple, dict[tuple, int]] = {}
    for op, ids, row in changes:
        counts = by_key.get(ids)
        if counts is None:
            counts = by_key[ids] = {}
        counts[row] = counts.get(row, 0) + (1 if op == INSERT else -1)
    return by_key


def split(change: dict[tuple, int]) -> tuple[dict[tuple, int], dict[tuple, int]]:
    """Rows that go and rows that come."""
    return {row: n for row, n in change.items() if n < 0}, {row: n for row, n in change.items() if n > 0}


class KeptRows:
    """Rows with whole numbers (how many there are, how many partners they have) in the state of one group.

    They lie under their first ``width`` values. In state they are a list of packs, which is read in one call and written in
    one: new rows are appended as a pack, and the list is written anew, as one pack, only when a row in it has changed or when it
    has ``PACKS``. State entries of single rows would take longer to convert, one by one, than the join itself. With a time to
    live each row is an entry of a map instead, so that it expires by itself.
    """

    PACKS = 32

    def __init__(
        self, handle: StatefulProcessorHandle, name: str, schema: T.StructType, numbers: Sequence[str], ttl_ms: int | None, width: int = 0
    ):
        self.ttl_ms, self.width, self.packs = ttl_ms, width, 0
        counted = T.StructType([T.StructField(n, T.LongType()) for n in numbers])
        if ttl_ms:
            self.state = handle.getMapState(name, schema, counted, ttl_ms)
        else:
            self.state = handle.getListState(name, "rows binary")

    def load(self) -> dict[tuple, dict[tuple, tuple]]:
        self.rows: dict[tuple, dict[tuple, tuple]] = {}
        self.new: dict[tuple, dict[tuple, tuple]] = {}
        self.packs, self.rewritten, self.changed, self.gone = 0, False, set(), set()
        if self.ttl_ms:
            for row, numbers in self.state.iterator():
                self.rows.setdefault(tuple(row[: self.width]), {})[tuple(row[self.width :])] = tuple(numbers)
            return self.rows
        for (pack,) in self.state.get():
            self.packs += 1
            some = pickle.loads(pack)
            if self.packs == 1:
                self.rows = some
                continue
            for ids, rows in some.items():
                if ids in self.rows:
                    self.rows[ids].update(rows)
                else:
                    self.rows[ids] = rows
        return self.rows

    def replace(self, ids: tuple, after: dict[tuple, tuple], changed: Iterable[tuple]) -> None:
        """The rows under ``ids`` are ``after`` from now on; only those in ``changed`` may differ."""
        before = self.rows.get(ids, {})
        new = {}
        for row in changed:
            was, now = before.get(row), after.get(row)
            if was == now:
                continue
            if was is None:
                new[row] = now
            else:
                self.rewritten = True
            if self.ttl_ms:
                (self.gone if now is None else self.changed).add((*ids, *row))
        if new:
            self.new[ids] = new
        if after:
            self.rows[ids] = after
        else:
            self.rows.pop(ids, None)

    def save(self, touched: Iterable[tuple] = ()) -> None:
        """``touched`` rows start their time to live anew, changed or not."""
        if self.ttl_ms:
            for row in self.gone:
                self.state.removeKey(row)
            for row in self.changed.union(touched):
                numbers = self.rows.get(row[: self.width], {}).get(row[self.width :])
                if numbers is not None:
                    self.state.updateValue(row, numbers)
        elif not self.rows:
            if self.packs:
                self.state.clear()
        elif self.rewritten or (self.new and self.packs >= self.PACKS):
            self.state.put([(pickle.dumps(self.rows),)])
        elif self.new:
            self.state.appendValue((pickle.dumps(self.new),))


_ONE = (1,)


def changed_counts(counts: dict[tuple, tuple], *changes: dict[tuple, int]) -> dict[tuple, tuple]:
    """Rows with their number after changes; what is not there cannot go."""
    if not any(changes):
        return counts
    after = dict(counts)
    for change in changes:
        for row, n in change.items():
            count = after.get(row, (0,))[0] + n
            if count > 0:
                after[row] = _ONE if count == 1 else (count,)
            else:
                after.pop(row, None)
    return after


class _DeltaJoin(StatefulProcessor):
    """First stage: joined rows and padded rows of the keys of one cell and salt.

    ``pad_right`` pads right rows at once, for keys that are not spread; ``report`` leaves it to the second stage.
    """

    def __init__(self, ids, left, right, pad_left, pad_right, report, ttl_ms):
        self.ids, self.left, self.right = ids, left, right
        self.pad_left, self.pad_right, self.report, self.ttl_ms = pad_left, pad_right, report, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lefts = KeptRows(handle, "left", T.StructType([*self.ids.fields, *self.left.fields]), ["_n"], self.ttl_ms, len(self.ids))
        self.rights = KeptRows(handle, "right", T.StructType([*self.ids.fields, *self.right.fields]), ["_n"], self.ttl_ms, len(self.ids))
        self.no_left = (None,) * len(self.left)
        self.no_right = (None,) * len(self.right)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        cell, salt = tuple(key)
        padding = []  # what the second stage needs, in a lane of its own
        yield from packs.give(self._changes(salt, packs.read_sides(rows, "l", "r"), padding), _cell=cell, _lane=salt)
        yield from packs.give(iter(padding), _cell=cell, _lane=-1)

    def _changes(self, salt: int, sides: dict[str, list[tuple]], padding: list[tuple]) -> Iterator[tuple]:
        left_change, right_change = _net_by_key(sides["l"]), _net_by_key(sides["r"])
        lefts, rights = self.lefts.load(), self.rights.load()
        touched: tuple[list[tuple], list[tuple]] = ([], [])
        nothing: dict = {}
        for ids in left_change.keys() | right_change.keys():
            yield from self._changes_of_key(
                ids, salt, lefts.get(ids, nothing), rights.get(ids, nothing), left_change.get(ids, nothing),
                right_change.get(ids, nothing), touched, padding,
            )
        self.lefts.save(touched[0])
        self.rights.save(touched[1])

    def _changes_of_key(self, ids, salt, lefts, rights, left_change, right_change, touched, padding) -> Iterator[tuple]:
        def out(change: int, left: tuple, right: tuple) -> Iterator[tuple]:
            return repeat((INSERT if change > 0 else DELETE, *ids, *left, *right), abs(change))

        if self.report and salt == 0:
            padding.extend((_RIGHT, change, ids, right) for right, change in right_change.items())
        if any(v is None for v in ids):
            # a NULL key never meets a partner, so nothing has to be kept
            if self.pad_left:
                for left, change in left_change.items():
                    yield from out(change, left, self.no_right)
            if self.pad_right:
                for right, change in right_change.items():
                    yield from out(change, self.no_left, right)
            return

        left_removed, left_added = split(left_change)
        right_removed, right_added = split(right_change)
        left_rest, right_rest = changed_counts(lefts, left_removed), changed_counts(rights, right_removed)
        left_now, right_now = changed_counts(left_rest, left_added), changed_counts(right_rest, right_added)

        # removed left rows leave the right rows of before
        yield from self._pairs(left_removed, rights, out)
        # changed right rows meet the left rows that are left
        for left, (count,) in left_rest.items() if right_change else ():
            for right, n in right_removed.items():
                yield from out(n * count, left, right)
            if self.pad_left and bool(rights) != bool(right_now):
                yield from out(count if rights else -count, left, self.no_right)
            for right, n in right_added.items():
                yield from out(n * count, left, right)
        # new left rows meet the right rows of now
        yield from self._pairs(left_added, right_now, out)

        if self.pad_right:
            if not lefts:
                for right, n in right_removed.items():
                    yield from out(n, self.no_left, right)
            if bool(lefts) != bool(left_now):
                for right, (count,) in right_rest.items():
                    yield from out(count if lefts else -count, self.no_left, right)
            if not left_now:
                for right, n in right_added.items():
                    yield from out(n, self.no_left, right)
        if self.report and bool(lefts) != bool(left_now):
            padding.append((_OCCUPANCY, -1 if lefts else 1, ids, None))

        if self.ttl_ms:
            # rows that met a change of the other side, and those that were changed
            met_lefts = left_now if right_change and right_now else left_change
            met_rights = right_now if left_change else right_change
            touched[0].extend((*ids, *row) for row in met_lefts)
            touched[1].extend((*ids, *row) for row in met_rights)
        if left_change:
            self.lefts.replace(ids, left_now, left_change)
        if right_change:
            self.rights.replace(ids, right_now, right_change)

    def _pairs(self, change: dict[tuple, int], rights: dict[tuple, tuple], out) -> Iterator[tuple]:
        for right, (count,) in rights.items() if change else ():
            for left, n in change.items():
                yield from out(n * count, left, right)
        if not rights and self.pad_left:
            for left, n in change.items():
                yield from out(n, left, self.no_right)

    def close(self) -> None:
        pass


class _PadRight(StatefulProcessor):
    """Second stage: padded right rows of the keys of one cell; joined rows pass through in groups of their own."""

    def __init__(self, ids, left, right):
        self.ids, self.left, self.right = ids, left, right

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.groups = KeptRows(handle, "groups", self.ids, ["_n"], None)
        self.rights = KeptRows(handle, "right", T.StructType([*self.ids.fields, *self.right.fields]), ["_n"], None, len(self.ids))
        self.no_left = (None,) * len(self.left)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        cell, lane = tuple(key)
        if lane >= 0:
            for row in rows:
                yield Row(_cell=cell, _lane=lane, _pack=row["_pack"])
        else:
            yield from packs.give(self._changes(packs.read(rows)), _cell=cell, _lane=lane)

    def _changes(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        change: dict[tuple, dict[tuple, int]] = defaultdict(lambda: defaultdict(int))
        occupancy: dict[tuple, int] = defaultdict(int)
        for kind, n, ids, right in rows:
            if kind == _OCCUPANCY:
                occupancy[ids] += n
            else:
                change[ids][right] += n

        groups, rights = self.groups.load().get((), {}), self.rights.load()
        for ids in change.keys() | occupancy.keys():

            def out(n: int, right: tuple) -> Iterator[tuple]:
                return repeat((INSERT if n > 0 else DELETE, *ids, *self.no_left, *right), abs(n))

            removed, added = split(change.get(ids, {}))
            before = groups.get(ids, (0,))[0]
            after = before + occupancy.get(ids, 0)
            if before == 0:
                for right, n in removed.items():
                    yield from out(n, right)
            if (before == 0) != (after == 0):
                for right, (count,) in changed_counts(rights.get(ids, {}), removed).items():
                    yield from out(count if after == 0 else -count, right)
            if after == 0:
                for right, n in added.items():
                    yield from out(n, right)
            # rows of a NULL key have no number of partners to wait for
            if ids in change:
                self.rights.replace(ids, changed_counts(rights.get(ids, {}), removed, added), change[ids])
        self.groups.replace((), changed_counts(groups, occupancy), occupancy)
        self.groups.save()
        self.rights.save()

    def close(self) -> None:
        pass


def changelog_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salting: Salting = NO_SALTING,
    ttl_ms: int | None = None,
    cells: int = CELLS,
) -> DataFrame:
    """Inner, left, right or full join of two streams on equal keys, as a changelog.

    A side without a column ``_op`` only adds rows. The result has ``_op``, the keys and the other columns of both
    sides, whose names must differ. ``salting`` must stay the same for the life of a checkpoint
    (``salting.kept_with``), and so must ``cells``: the keys are dealt to so many groups by their hash, and the rows of a group
    are in memory while it is changed. With ``ttl_ms`` a row that has not met a partner for that long leaves the state; only inner and
    left joins take it.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be inner, left, right or full")
    if ttl_ms and how in ("right", "full"):
        # whether a right row has partners is counted in another group than the partners expire in
        raise ValueError("right and full joins with a time to live: use delta_join.start_changelog_join")
    keys = list(on)

    def payload(df: DataFrame) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in (*keys, "_op")])

    left_schema, right_schema = payload(left), payload(right)
    if set(left_schema.names) & set(right_schema.names):
        raise ValueError("rename the columns that both sides have")
    if not left_schema.fields or not right_schema.fields:
        raise ValueError("each side needs a column besides the keys")

    def with_op(df: DataFrame) -> DataFrame:
        return df if "_op" in df.columns else df.withColumn("_op", F.lit(INSERT))

    # a key must have one type on both sides, also for the choice of its salts
    for k in keys:
        right = right.withColumn(k, F.col(k).cast(left.schema[k].dataType))
    def packed(df: DataFrame, side: str, schema: T.StructType) -> DataFrame:
        dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*keys), F.lit(cells)).cast("int"))
        return packs.pack(dealt, ["_cell", "_salt"], ["_op", keys, schema.names], side)

    lefts = salting.spread(with_op(left), keys, [*keys, *left_schema.names])
    rights = salting.copy(with_op(right), keys)
    changes = packed(lefts, "l", left_schema).unionByName(packed(rights, "r", right_schema))

    key_fields = [T.StructField(k, left.schema[k].dataType) for k in keys]
    pad_left, pad_right = how in ("left", "full"), how in ("right", "full")
    # only a key that is spread has left rows in more than one group
    report = pad_right and not salting.idle
    mode = "ProcessingTime" if ttl_ms else "None"
    ids = T.StructType(key_fields)
    first = _DeltaJoin(ids, left_schema, right_schema, pad_left, pad_right and not report, report, ttl_ms)
    staged = packs.packed_schema(*[T.StructField(n, T.IntegerType()) for n in ("_cell", "_lane")])
    result = changes.groupBy("_cell", "_salt").transformWithState(first, staged, "append", mode)
    if report:
        # joined rows stay spread over the salts, what the padding needs meets in one group per cell
        second = _PadRight(ids, left_schema, right_schema)
        result = result.groupBy("_cell", "_lane").transformWithState(second, staged, "append", mode)
    output = T.StructType([T.StructField("_op", T.StringType()), *key_fields, *left_schema.fields, *right_schema.fields])
    return packs.unpack(result, output)
