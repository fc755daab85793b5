"""Work of the changelog joins in terms of what changed."""

import datetime
import decimal
import os
import pickle

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import stream
from millrace.plans import tables as t
from millrace.session import fair_partitions
from millrace.streaming import changelog_band, changelog_join, delta_join, kept, packs, runner


class _List:
    """A list state of one group."""

    def __init__(self):
        self.values = []

    def get(self):
        return iter(self.values)

    def put(self, values):
        self.values = list(values)

    def appendValue(self, value):
        self.values.append(value)

    def clear(self):
        self.values = []


class _Handle:
    def getListState(self, name, schema):
        return _List()


class _Counted(int):
    """A number that counts how often it is looked up."""

    looks = 0

    def __hash__(self):
        _Counted.looks += 1
        return int.__hash__(self)


def _numbers(*names):
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def _joined(processor, **sides):
    given = [{"_pack": pickle.dumps((side, rows))} for side, rows in sides.items()]
    return sorted(packs.read(processor.handleInputRows((0, 0), iter(given), None)), key=str)


def test_a_change_looks_at_the_rows_of_its_keys_only():
    processor = changelog_join._DeltaJoin(_numbers("k"), _numbers("a"), _numbers("b"), True, True, False, None)
    processor.init(_Handle())
    _joined(processor, l=[("+I", (k,), (_Counted(k * 10 + n),)) for k in range(50) for n in range(20)])
    stored = len(processor.lefts.state.values)
    _Counted.looks = 0
    assert _joined(processor, l=[("+I", (1,), (7,))], r=[("+I", (99,), (1,))]) == [("+I", 1, 7, None), ("+I", 99, None, 1)]
    # read once, and no more of the 980 rows of other keys
    assert _Counted.looks <= 1000 + 40
    assert len(processor.lefts.state.values) == stored + 1
    # rows of another micro-batch of the same key come together
    assert len(_joined(processor, r=[("+I", (1,), (5,))])) == 2 * 21
    assert _joined(processor, l=[("-D", (1,), (7,))]) == [("-D", 1, 7, 5)]
    assert len(processor.lefts.state.values) == 1


def test_kept_rows_of_a_band_are_looked_up_at_once():
    line = changelog_band._Line({(5, "a"): 1, (9, "b"): 2, (1, "c"): 1}, 0)
    assert [(row, near) for row, near in line.met([(6,), (1,), (20,)], 0, -2, 3)] == [
        ((6,), [((5, "a"), 1), ((9, "b"), 2)]), ((1,), [((1, "c"), 1)])
    ]
    far = 2**63 - 1
    for shift, places in ((decimal.Decimal("0.5"), (5, 9)), (far, (far - 1, far))):
        rows = {(p,): 1 for p in places}
        line = changelog_band._Line(rows, 0)
        kept = [(places[0] if shift == far else shift,), (places[1],)]
        assert [(r, n) for r, n in line.met(kept, 0, -1, 10)] == [(r, line.near(r[0], -1, 10)) for r in kept if line.near(r[0], -1, 10)]


def test_columns_are_unpacked_as_arrow_does():
    day = datetime.date(2024, 1, 1)
    for values in ([1, None, 2**62 + 1], [3, 2**62 + 1], [None, None], ["a", None, "é"], [1.5, None], [1.5, 2.0], [True, False], [day, None]):
        column = pa.array(values)
        assert packs._values(column) == values and [type(v) for v in packs._values(column)] == [type(v) for v in values]
    assert packs._values(pa.array([], pa.string())) == []


def test_messages_of_a_small_table_are_dealt_evenly(spark):
    arrivals = stream._customer_messages(spark, "/root/testdata/sf0.01")
    messages = arrivals.tables["messages"][0]
    assert messages.rdd.getNumPartitions() == fair_partitions(spark)


def test_a_delta_join_judges_its_rows_once_per_micro_batch(spark, folder, monkeypatch):
    for name, schema in (("left", "k int, a int"), ("right", "k int, b int")):
        spark.createDataFrame([(1, 1), (2, 2), (None, 3)], schema).write.parquet(f"{folder}/{name}")
    left, right = (spark.readStream.schema(s).parquet(f"{folder}/{n}") for n, s in (("left", "k int, a int"), ("right", "k int, b int")))
    write, inputs = kept.KeptRows.write, []

    def recorded(self, changes, batch_id):
        inputs.append(changes._jdf.queryExecution().withCachedData().collectLeaves().size())
        write(self, changes, batch_id)

    monkeypatch.setattr(kept.KeptRows, "write", recorded)
    runner.finish(delta_join.start_changelog_join(left, right, ["k"], f"{folder}/out", f"{folder}/c", "left", 10.0, 4, clock=lambda: 1.0))
    # both sides' changes are read from what was counted and kept for the result, not joined again
    assert inputs == [1, 1]
    found = runner.read_batches(spark, f"{folder}/out").select("_op", "k", "a", "b").collect()
    assert sorted(map(tuple, found), key=str) == [("+I", 1, 1, 1), ("+I", 2, 2, 2), ("+I", None, 3, None)]


def test_a_delivery_of_any_size_is_one_micro_batch_of_a_band_join(spark, folder, monkeypatch):
    # each micro-batch reads the state of all buckets, so their number must not grow with the input
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(t, "KEYED_BATCH_BYTES", 1)
    joined = stream.stream_join_theta_left(spark, folder)
    run = joined.inputFiles()[0].removeprefix("file:").removeprefix("//").split("/rows/")[0]
    assert len([name for name in os.listdir(f"{run}/checkpoint/commits") if name.isdigit()]) == t.PARTS


def test_rows_without_a_place_are_dealt_to_many_groups(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("place"), (F.col("id") % 100).alias("a"), F.lit(3).alias("_salt")
    )
    dealt = changelog_band.deal_lost(rows, ["place"], ["place", "a"])
    assert {r["_salt"] for r in dealt.where("place IS NOT NULL").collect()} == {3}
    lost = {(r["a"], r["_salt"]) for r in dealt.where("place IS NULL").collect()}
    # equal rows stay together, so that they are netted
    assert len(lost) == 50 and len({salt for _, salt in lost}) > 25
