"""Streams: files are added one per micro-batch, and queries are stopped and started again."""

import json
import os
import random
import time
from datetime import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.operators import aggregates, joins, windows
from millrace.operators.salting import Salting, kept_with
from millrace.sinks import messages as sink_messages
from millrace.sources import changelog, messages
from millrace.streaming import carried, changelog_band, delta_join, kept, keyed, lookup, ordering, runner
from millrace.streaming.changelog_band import changelog_band_join
from millrace.streaming.changelog_join import changelog_join
from tests.test_batch import first_arrival_by_hand


class Feed:
    """A folder of JSON files; each call of ``add`` makes one file and thereby one micro-batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.count = spark, path, schema, 0
        os.makedirs(path)

    def add(self, *rows):
        self.count += 1
        temporary = f"{self.path}/.{self.count}"
        with open(temporary, "w") as handle:
            handle.writelines(json.dumps(row) + "\n" for row in rows)
        stamp = 1_700_000_000 + self.count
        os.utime(temporary, (stamp, stamp))
        os.rename(temporary, f"{self.path}/{self.count:05}.json")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(self.path)


@pytest.fixture
def feed(spark, folder):
    return lambda name, schema: Feed(spark, f"{folder}/{name}", schema)


@pytest.fixture
def run(spark, folder):
    """Run a stream over what there is, resuming where the last run stopped, and give all it has written."""

    def start(df, name="out"):
        runner.finish(runner.start_append(df, f"{folder}/{name}", f"{folder}/{name}-checkpoint"))
        return runner.read_append(spark, f"{folder}/{name}", df)

    return start


def income_feed(feed):
    income = feed("income", "amount int, ts timestamp")
    income.add(
        {"amount": 10, "ts": "2024-01-01 00:00:00"}, {"amount": 20, "ts": "2024-01-01 00:59:59"},
        {"amount": 30, "ts": "2024-01-01 01:00:00"}, {"amount": 40, "ts": "2024-01-01 05:30:00"},
        {"amount": 50, "ts": "2024-01-02 00:10:00"},
    )
    income.add({"amount": 1, "ts": "2024-01-02 00:20:00"})
    income.add({"amount": 99, "ts": "2024-01-01 00:30:00"}, {"amount": 2, "ts": "2024-01-02 00:05:00"})
    income.add({"amount": 3, "ts": "2024-01-02 01:00:00"})
    return income


def test_tumbling_windows_close_and_drop_late_rows(feed, run, rows):
    stream = windows.with_watermark(income_feed(feed).stream(), "ts")
    out = run(windows.tumble(stream, "ts", "1 hour", [F.sum("amount").alias("t")]))
    assert rows(out, "window_start", "t") == [
        (dt(2024, 1, 1, 0), 30), (dt(2024, 1, 1, 1), 30), (dt(2024, 1, 1, 5), 40), (dt(2024, 1, 2, 0), 53),
    ]


def test_cumulating_windows_emit_steps_without_rows(feed, run):
    stream = windows.with_watermark(income_feed(feed).stream(), "ts")
    out = run(windows.cumulate(stream, "ts", "1 hour", "1 day", {"t": ("sum", "amount")}))
    found = {(r["window_start"].day, r["window_end"]): r["t"] for r in out.collect()}
    assert len(found) == 25 and found.pop((2, dt(2024, 1, 2, 1))) == 53
    assert [found[(1, e)] for _, e in sorted(found)] == [30] + [60] * 4 + [100] * 19


def test_late_rows_still_count_in_windows_that_are_open(feed, run):
    income = feed("income", "amount int, ts timestamp")
    income.add({"amount": 10, "ts": "2024-01-01 02:10:00"}, {"amount": 20, "ts": "2024-01-01 05:30:00"})
    income.add({"amount": 1, "ts": "2024-01-01 05:31:00"})
    # behind the watermark: too late for the windows that end by 05:30, in time for the others
    income.add({"amount": 100, "ts": "2024-01-01 02:40:00"}, {"amount": 1000, "ts": "2024-01-01 05:10:00"})
    income.add({"amount": 0, "ts": "2024-01-02 00:00:00"})
    merged = {"t": ("sum", "amount")}
    grown = run(windows.cumulate(windows.with_watermark(income.stream(), "ts"), "ts", "1 hour", "1 day", merged), "grown")
    found = {r["window_end"].hour: r["t"] for r in grown.where("window_end <= '2024-01-01 08:00:00'").collect()}
    assert found == {3: 10, 4: 10, 5: 10, 6: 1131, 7: 1131, 8: 1131}
    hopped = run(windows.hop(windows.with_watermark(income.stream(), "ts"), "ts", "10 minutes", "1 hour", merged), "hopped")
    found = {(r["window_end"].hour, r["window_end"].minute): r["t"] for r in hopped.where("window_end > '2024-01-01 05:00:00'").collect()}
    assert found[(5, 40)] == 1021 and found[(6, 10)] == 1021 and found[(6, 20)] == 21


def test_hopping_windows_stream_equals_batch(feed, run, rows, spark):
    income = feed("income", "amount int, ts timestamp")
    random.seed(5)
    for part in range(4):
        income.add(*[{"amount": random.randrange(9), "ts": f"2024-01-01 0{part}:{random.randrange(60):02}:00"} for _ in range(30)])
    income.add({"amount": 0, "ts": "2024-01-03 00:00:00"})
    total = [F.sum("amount").alias("t")]
    out = run(windows.hop(windows.with_watermark(income.stream(), "ts", "1 hour"), "ts", "10 minutes", "1 hour", total))
    table = spark.read.schema(income.schema).json(income.path).where("ts < '2024-01-02'")
    assert rows(out) == rows(windows.hop(table, "ts", "10 minutes", "1 hour", total))


def test_windows_survive_a_restart(feed, run, rows):
    income = feed("income", "amount int, ts timestamp")

    def build():
        stream = windows.with_watermark(income.stream(), "ts")
        return windows.tumble(stream, "ts", "1 hour", [F.sum("amount").alias("t")])

    income.add({"amount": 1, "ts": "2024-01-01 00:10:00"})
    assert run(build()).count() == 0
    income.add({"amount": 2, "ts": "2024-01-01 00:20:00"}, {"amount": 5, "ts": "2024-01-01 01:00:00"})
    assert rows(run(build()), "t") == [(3,)]
    income.add({"amount": 7, "ts": "2024-01-01 02:00:00"})
    assert rows(run(build()), "t") == [(3,), (5,)]


def test_grouped_sum_updates(spark, feed, folder):
    score = feed("score", "stuname string, score int")
    score.add({"stuname": "a", "score": 1}, {"stuname": "b", "score": 5})
    score.add({"stuname": "a", "score": 2})
    sums = aggregates.group_sum(score.stream(), ["stuname"], "score", "total_score")
    runner.finish(runner.start_batches(sums, f"{folder}/out", f"{folder}/checkpoint"))
    out = {(r["batch"], r["stuname"], r["total_score"]) for r in runner.read_batches(spark, f"{folder}/out").collect()}
    assert out == {(0, "a", 1), (0, "b", 5), (1, "a", 3)}


def test_processing_time_windows_hold_each_row_once(spark, feed, folder):
    income = feed("income", "amount int")
    income.add({"amount": 1}, {"amount": 2})
    income.add({"amount": 4})
    out = windows.tumble_by_processing_time(income.stream(), "1 minute", [F.sum("amount").alias("t")])
    runner.finish(runner.start_batches(out, f"{folder}/out", f"{folder}/checkpoint"))
    updates = runner.read_batches(spark, f"{folder}/out")
    assert updates.groupBy("window_start").agg(F.max_by("t", "batch").alias("t")).agg(F.sum("t")).collect()[0][0] == 7


def test_stream_is_ordered_by_time(spark, feed, folder):
    score = feed("score", "n int, ts timestamp")
    random.seed(11)
    for part in range(5):
        seconds = [part * 60 + random.randrange(75) for _ in range(40)]
        score.add(*[{"n": s, "ts": f"2024-01-01 00:{s // 60:02}:{s % 60:02}"} for s in seconds])
    score.add({"n": 0, "ts": "2024-01-01 01:00:00"})
    runner.finish(ordering.start_ordered(score.stream(), "ts", f"{folder}/out", f"{folder}/checkpoint", "30 seconds", "20 seconds"))
    out = runner.read_batches(spark, f"{folder}/out")
    bounds = [(r["low"], r["high"]) for r in out.groupBy("batch").agg(F.min("n").alias("low"), F.max("n").alias("high")).orderBy("batch").collect()]
    assert out.count() == 200 and len(bounds) > 1
    assert all(earlier[1] < later[0] for earlier, later in zip(bounds, bounds[1:]))
    for batch in sorted({r["batch"] for r in out.select("batch").distinct().collect()}):
        # the parts of a sorted result follow each other by name
        parts = sorted(name for name in os.listdir(f"{folder}/out/batch={batch}") if name.startswith("part-"))
        values = [v for name in parts for v in pq.read_table(f"{folder}/out/batch={batch}/{name}")["n"].to_pylist()]
        assert values == sorted(values)


def test_rows_of_complete_buckets_that_come_late_are_dropped(spark, feed, folder):
    score = feed("score", "n int, ts timestamp")

    def add(*minutes):
        score.add(*[{"n": m, "ts": None if m is None else f"2024-01-01 00:{m:02}:30"} for m in minutes])
        runner.finish(ordering.start_ordered(score.stream(), "ts", f"{folder}/out", f"{folder}/checkpoint", "60 seconds", "1 minute"))
        return [r["n"] for r in runner.read_batches(spark, f"{folder}/out").orderBy("batch", "ts").collect()]

    assert add(None) == [] and add(5, 1) == [1]
    # up to minute 4 all is complete: 3 comes too late, 4 does not
    assert add(9, 3, 4) == [1, 4, 5]
    assert add() == [1, 4, 5] and add(20) == [1, 4, 5, 9]


def test_a_bucket_is_complete_when_the_watermark_reaches_its_end(spark, feed, folder):
    score = feed("score", "n int, ts timestamp")

    def add(**rows):
        score.add(*[{"n": int(n[1:]), "ts": f"2024-01-01 00:{ts}"} for n, ts in rows.items()])
        runner.finish(ordering.start_ordered(score.stream(), "ts", f"{folder}/out", f"{folder}/checkpoint", "30 seconds", "1 minute"))
        return [r["n"] for r in runner.read_batches(spark, f"{folder}/out").orderBy("batch", "ts").collect()]

    assert add(n1="28:30", n2="29:29.999") == []
    assert add(n3="28:59.999", n4="29:30") == [1, 3]
    assert add(n5="28:59", n6="29:59", n7="40:00") == [1, 3, 2, 4, 6]


def test_lists_of_waiting_rows_are_not_written_again(spark, feed, folder):
    score = feed("score", "n int, ts timestamp")
    for n in (1, 2, 3):
        score.add({"n": n, "ts": f"2024-01-01 00:00:0{n}"})
        query = ordering.start_ordered(score.stream(), "ts", f"{folder}/out", f"{folder}/checkpoint", salts=1)
        runner.finish(query)
    # one list for each micro-batch, though all rows are of one bucket
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3


def test_sorted_sweep_compares_rows_inside_the_band_only():
    line = changelog_band._Line({(5, "a"): 1, (9, "b"): 2, (1, "c"): 1, (9, "d"): 1}, 0)
    assert line.near(6, -1, 3) == [((5, "a"), 1), ((9, "b"), 2), ((9, "d"), 1)]
    assert line.near(6, -4, -2) == [] and line.near(1, 0, 0) == [((1, "c"), 1)]
    assert changelog_band._Line({}, 0).near(1, 0, 9) == []


@pytest.mark.parametrize("salting", [Salting(1), Salting(3)])
def test_inner_join_of_two_streams(feed, run, rows, salting):
    scores = feed("scores", "stu_no int, score int")
    students = feed("students", "stu_no int, stu_name string")

    def build():
        return joins.regular_join(scores.stream(), students.stream(), ["stu_no"], salting=salting)

    scores.add({"stu_no": 1, "score": 10}, {"stu_no": 2, "score": 20})
    students.add({"stu_no": 1, "stu_name": "a"})
    assert rows(run(build())) == [(1, 10, "a")]
    students.add({"stu_no": 2, "stu_name": "b"}, {"stu_no": 1, "stu_name": "c"})
    scores.add({"stu_no": 1, "score": 11})
    assert rows(run(build())) == [(1, 10, "a"), (1, 10, "c"), (1, 11, "a"), (1, 11, "c"), (2, 20, "b")]


def test_band_join_of_two_streams(spark, feed, run, rows):
    random.seed(2)
    left, right = feed("left", "x int, a int"), feed("right", "y int, b int")
    for _ in range(3):
        left.add(*[{"x": random.randrange(100), "a": random.randrange(5)} for _ in range(30)])
        right.add(*[{"y": random.randrange(100), "b": random.randrange(5)} for _ in range(30)])
    out = run(joins.band_join(left.stream(), right.stream(), "x", "y", -4, 2, condition=F.col("a") != F.col("b")))
    l, r = (spark.read.schema(f.schema).json(f.path) for f in (left, right))
    expected = l.join(r, (F.col("y") - F.col("x")).between(-4, 2) & (F.col("a") != F.col("b")))
    assert rows(out) == rows(expected)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_changelog_join_nets_to_the_batch_join(spark, feed, run, rows, how):
    random.seed(7)
    left, right = feed("left", "_op string, k int, a int"), feed("right", "_op string, k int, b string")
    live_left, live_right = [], []

    def change(live, name, value):
        if live and random.random() < 0.4:
            row = live.pop(random.randrange(len(live)))
            return {"_op": "-D", **row}
        row = {"k": random.choice([None, 1, 2, 3, 4, 5]), name: value}
        live.append(row)
        return {"_op": "+I", **row}

    for _ in range(3):
        left.add(*[change(live_left, "a", random.randrange(3)) for _ in range(40)])
        right.add(*[change(live_right, "b", random.choice("xyz")) for _ in range(40)])
        run(changelog_join(left.stream(), right.stream(), ["k"], how, Salting(3)))
    out = run(changelog_join(left.stream(), right.stream(), ["k"], how, Salting(3)))
    l = spark.createDataFrame([(r["k"], r["a"]) for r in live_left], "k int, a int")
    r = spark.createDataFrame([(r["k"], r["b"]) for r in live_right], "k int, b string")
    expected = l.join(r, "k", how).select("k", "a", "b")
    got = changelog.materialize(out)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.fixture
def delta(spark, folder):
    """Run the join over what has come since the last run, at a given time; gives the new rows."""

    def start(left, right, how, at=0.0, ttl=None):
        query = delta_join.start_changelog_join(
            left, right, ["k"], f"{folder}/out", f"{folder}/checkpoint", how, ttl, buckets=3, clock=lambda: at
        )
        runner.finish(query)
        return runner.read_batches(spark, f"{folder}/out")

    return start


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_delta_join_nets_to_the_batch_join(spark, feed, delta, how, monkeypatch):
    monkeypatch.setattr(kept, "FOLDED", 2)
    random.seed(8)
    left, right = feed("left", "_op string, k int, a int"), feed("right", "_op string, k int, b string")
    live_left, live_right = [], []

    def change(live, name, value):
        if live and random.random() < 0.4:
            return {"_op": "-D", **live.pop(random.randrange(len(live)))}
        row = {"k": random.choice([None, 1, 2, 3, 4, 5]), name: value}
        live.append(row)
        return {"_op": "+I", **row}

    for _ in range(5):
        left.add(*[change(live_left, "a", random.randrange(3)) for _ in range(20)])
        right.add(*[change(live_right, "b", random.choice("xyz")) for _ in range(20)])
        out = delta(left.stream(), right.stream(), how)
    l = spark.createDataFrame([(r["k"], r["a"]) for r in live_left], "k int, a int")
    r = spark.createDataFrame([(r["k"], r["b"]) for r in live_right], "k int, b string")
    expected = l.join(r, "k", how).select("k", "a", "b")
    got = changelog.materialize(out.drop("batch"))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    assert how == "inner" or out.where("_op = '-D' AND (a IS NULL OR b IS NULL)").count() > 0


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_delta_join_forgets_what_nobody_meets(feed, delta, how):
    left, right = feed("left", "_op string, k int, a int"), feed("right", "_op string, k int, b string")
    right.add()
    seen = 0

    def step(at, lefts=(), rights=()):
        nonlocal seen
        left.add(*[{"_op": op, "k": k, "a": a} for op, k, a in lefts])
        right.add(*[{"_op": op, "k": k, "b": b} for op, k, b in rights])
        out = delta(left.stream(), right.stream(), how, at, 5.0).collect()
        new = sorted((r["_op"], r["k"], r["a"] or 0, r["b"] or "") for r in out if r["batch"] >= seen)
        seen = max((r["batch"] for r in out), default=-1) + 1
        return new

    pads_left, pads_right = how in ("left", "full"), how in ("right", "full")

    def when(condition, *rows):
        return list(rows) if condition else []

    assert step(0, [("+I", 1, 1)]) == when(pads_left, ("+I", 1, 1, ""))
    # the left row is forgotten, so the right one meets nobody
    assert step(10, [], [("+I", 1, "x")]) == when(pads_right, ("+I", 1, 0, "x"))
    assert step(12, [("+I", 1, 2)]) == sorted([("+I", 1, 2, "x"), *when(pads_right, ("-D", 1, 0, "x"))])
    # met at 12, so still there at 16; the left row of 12 was met by nobody after that
    assert step(16, [("+I", 1, 3)]) == [("+I", 1, 3, "x")]
    # at 18 the left row of 12 is forgotten and cannot go any more; the one of 16 can, and the right row is alone
    assert step(18, [("-D", 1, 2), ("-D", 1, 3)]) == sorted([("-D", 1, 3, "x"), *when(pads_right, ("+I", 1, 0, "x"))])
    # a forgotten row that comes again is new
    assert step(40, [("+I", 1, 3)]) == when(pads_left, ("+I", 1, 3, ""))
    assert step(41, [], [("+I", 1, "x")]) == sorted([("+I", 1, 3, "x"), *when(pads_left, ("-D", 1, 3, ""))])


@pytest.mark.parametrize("how", ["inner", "full"])
def test_forgotten_rows_of_a_delta_join_leave_the_files(spark, feed, folder, delta, how, monkeypatch):
    monkeypatch.setattr(kept, "FOLDED", 2)
    left, right = feed("left", "k int, a int"), feed("right", "k int, b string")

    def held(side, base):
        return spark.read.schema("k int, _n bigint, _at bigint").parquet(f"{folder}/checkpoint-kept/{side}/base={base}").collect()

    for part in range(5):
        # a key comes once and never again; the right row of key 0 is met every time
        left.add({"k": 0, "a": part}, *[{"k": 1 + part * 20 + i, "a": i} for i in range(20)])
        right.add(*[{"k": 0, "b": "x"}][part:])
        delta(left.stream(), right.stream(), how, part * 100.0, 150.0)
    # folded in micro-batch 4, at 400 seconds
    assert sorted(r["k"] for r in held("l", 0)) == [0, *range(61, 81)] and {r["_at"] for r in held("l", 0)} == {300_000}
    assert [(r["k"], r["_n"], r["_at"]) for r in held("r", 0)] == [(0, 1, 300_000)]
    # all are forgotten, and after the next fold nothing is left of them
    for part in range(2):
        left.add({"k": -1 - part, "a": 0})
        right.add()
        delta(left.stream(), right.stream(), how, 10_000.0 + part, 150.0)
    assert [r["k"] for r in held("l", 1)] == [-1] and held("r", 1) == []


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_changelog_band_join_nets_to_the_batch_join(spark, feed, run, how):
    random.seed(13)
    left, right = feed("left", "_op string, g int, x int, a int"), feed("right", "_op string, g int, y int, b int")
    live_left, live_right = [], []

    def change(live, place, name):
        if live and random.random() < 0.4:
            return {"_op": "-D", **live.pop(random.randrange(len(live)))}
        row = {"g": random.choice([None, 1, 1, 1, 2]), place: random.choice([None, *range(12)]), name: random.randrange(3)}
        live.append(row)
        return {"_op": "+I", **row}

    def build():
        return changelog_band_join(
            left.stream(), right.stream(), "x", "y", -3, 1, how, ["g"], lambda l, r: l.a != r.b, Salting(2)
        )

    for _ in range(3):
        left.add(*[change(live_left, "x", "a") for _ in range(40)])
        right.add(*[change(live_right, "y", "b") for _ in range(40)])
        out = run(build())
    l = spark.createDataFrame([tuple(r.values()) for r in live_left], "g int, x int, a int")
    r = spark.createDataFrame([tuple(r.values()) for r in live_right], "h int, y int, b int")
    near = (F.col("g") == F.col("h")) & (F.col("y") - F.col("x")).between(-3, 1) & (F.col("a") != F.col("b"))
    expected = l.join(r, near, how).select(F.coalesce("g", "h").alias("g"), "x", "a", "y", "b")
    got = changelog.materialize(out)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_keyed_joins_keep_the_rows_of_many_keys_in_few_entries(spark, feed, folder, how):
    random.seed(17)
    left, right = feed("left", "k int, a int"), feed("right", "_op string, k int, b string")
    lefts, rights = [], []
    for part in range(2):
        new = [{"k": random.choice([None, *range(200)]), "a": part * 1000 + n} for n in range(150)]
        gone = [rights.pop(random.randrange(len(rights))) for _ in range(60 * part)]
        come = [{"k": random.choice([None, *range(200)]), "b": random.choice("xyz")} for _ in range(120)]
        left.add(*new)
        right.add(*[{"_op": "-D", **r} for r in gone], *[{"_op": "+I", **r} for r in come])
        lefts, rights = lefts + new, rights + come
        joined = changelog_join(left.stream(), right.stream(), ["k"], how, cells=3)
        query = runner.start_append(joined, f"{folder}/out", f"{folder}/checkpoint")
        runner.finish(query)
    l = spark.createDataFrame([(r["k"], r["a"]) for r in lefts], "k int, a int")
    r = spark.createDataFrame([(r["k"], r["b"]) for r in rights], "k int, b string")
    expected, got = l.join(r, "k", how).select("k", "a", "b"), changelog.materialize(runner.read_append(spark, f"{folder}/out", joined))
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    # at most one pack of left rows per micro-batch and one of right rows, in each of three cells
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * 2 * 2


def test_left_join_retracts_the_padded_row(feed, run, rows):
    scores = feed("scores", "stu_no int, sub_no int, score int")
    students = feed("students", "value string")

    def build():
        changes = changelog.decode_changes(students.stream(), "stu_no int, stu_name string").drop("_part")
        return changelog_join(scores.stream(), changes, ["stu_no"], "left")

    def envelope(**fields):
        return {"value": json.dumps(fields)}

    scores.add({"stu_no": 1, "sub_no": 1, "score": 90})
    first = rows(run(build()))
    assert first == [("+I", 1, 1, 90, None)]
    students.add(envelope(op="c", after={"stu_no": 1, "stu_name": "a"}))
    out = rows(run(build()))
    assert out == sorted(first + [("-D", 1, 1, 90, None), ("+I", 1, 1, 90, "a")], key=str)
    students.add(envelope(op="u", before={"stu_no": 1, "stu_name": "a"}, after={"stu_no": 1, "stu_name": "b"}))
    out = run(build())
    assert rows(changelog.materialize(out)) == [(1, 1, 90, "b")]
    students.add(envelope(op="d", before={"stu_no": 1, "stu_name": "b"}))
    assert rows(changelog.materialize(run(build()))) == [(1, 1, 90, None)]


@pytest.mark.parametrize("kind", ["equal", "band"])
def test_state_that_meets_no_partner_expires(spark, feed, folder, kind):
    left, right = feed("left", "k int, a int"), feed("right", "k int, b string")
    if kind == "equal":
        joined = changelog_join(left.stream(), right.stream(), ["k"], "left", ttl_ms=3_000)
    else:
        places = right.stream().withColumnRenamed("k", "r")
        joined = changelog_band_join(left.stream(), places, "k", "r", 0, 0, "left", ttl_ms=3_000).drop("r")
    query = runner.start_append(joined, f"{folder}/out", f"{folder}/checkpoint", {"processingTime": "200 milliseconds"})

    def wait_for(condition, limit=60):
        end = time.time() + limit
        while time.time() < end:
            if query.exception():
                raise query.exception()
            found = {tuple(r) for r in spark.read.schema(joined.schema).parquet(f"{folder}/out").collect()}
            if condition(found):
                return found
            time.sleep(0.3)
        raise AssertionError(found)

    try:
        os.makedirs(f"{folder}/out", exist_ok=True)
        left.add({"k": 1, "a": 10})
        wait_for(lambda found: ("+I", 1, 10, None) in found)
        time.sleep(5)
        left.add({"k": 2, "a": 20})
        wait_for(lambda found: ("+I", 2, 20, None) in found)
        right.add({"k": 1, "b": "late"}, {"k": 2, "b": "soon"})
        found = wait_for(lambda found: ("+I", 2, 20, "soon") in found)
        assert not any(row[-1] == "late" for row in found)
    finally:
        query.stop()


def test_first_arrival_join_stream(feed, run, rows):
    data1, data2 = feed("data1", "id int, seq int, name string"), feed("data2", "id int, seq int, score int")

    def build():
        return keyed.first_arrival_join(data1.stream(), data2.stream(), "id", "seq")

    data1.add({"id": 1, "seq": 1, "name": "a"}, {"id": 1, "seq": 2, "name": "b"})
    data2.add({"id": 1, "seq": 4, "score": 6}, {"id": 1, "seq": 3, "score": 5})
    assert rows(run(build()), "id", "name", "score") == [(1, "b", 5), (1, "b", 6)]
    data1.add({"id": 1, "seq": 5, "name": "c"}, {"id": 2, "seq": 8, "name": "z"}, {"id": 2, "seq": 9, "name": "w"})
    data2.add({"id": 1, "seq": 6, "score": 7}, {"id": 2, "seq": 7, "score": 9})
    assert rows(run(build()), "id", "name", "score") == [(1, "b", 5), (1, "b", 6), (1, "c", 7), (2, "w", 9), (2, "z", 9)]


def test_running_total_resumes_from_its_state(feed, run, rows):
    lines = feed("lines", "k int, seq int, v int")

    def build():
        return keyed.running_total(lines.stream(), "k", "seq", "v", "total")

    lines.add({"k": 1, "seq": 2, "v": 10}, {"k": 1, "seq": 1, "v": 5}, {"k": 2, "seq": 1})
    assert rows(run(build()), "k", "seq", "total") == [(1, 1, 5), (1, 2, 15), (2, 1, None)]
    lines.add({"k": 1, "seq": 3, "v": 1}, {"k": 2, "seq": 2, "v": 4})
    assert rows(run(build()), "k", "seq", "total")[2:] == [(1, 3, 16), (2, 1, None), (2, 2, 4)] or rows(
        run(build()), "k", "seq", "total"
    ) == [(1, 1, 5), (1, 2, 15), (1, 3, 16), (2, 2, 4), (2, 1, None)]


@pytest.mark.parametrize("blocks", [1, 5])
def test_large_batches_equal_keyed_state(spark, feed, folder, rows, blocks, monkeypatch):
    monkeypatch.setattr(kept, "FOLDED", 2)
    random.seed(blocks)
    left, right = feed("left", "id int, seq int, a int"), feed("right", "id int, seq int, b int")
    lines = feed("lines", "id int, seq int, v int")
    events, totals, expected = [], {}, []
    for part in range(6):
        mine = [(random.choice([1, 1, 1, 2, 3, 4 + part]), part * 100 + i, random.choice("lr"), random.randrange(50)) for i in range(60)]
        events += mine
        left.add(*[{"id": k, "seq": s, "a": v} for k, s, side, v in mine if side == "l"])
        right.add(*[{"id": k, "seq": s, "b": v} for k, s, side, v in mine if side == "r"])
        lines.add(*[{"id": k, "seq": s, "v": v} for k, s, _, v in mine])
        for k, s, _, v in mine:
            totals[k] = totals.get(k, 0) + v
            expected.append((k, s, totals[k]))
        if part % 2:
            # stop and start again after every other part
            runner.finish(carried.start_first_arrival_join(left.stream(), right.stream(), "id", "seq", f"{folder}/j", f"{folder}/jc", blocks))
            runner.finish(carried.start_running_total(lines.stream(), "id", "seq", "v", f"{folder}/t", f"{folder}/tc", "total", blocks))
    joined = runner.read_batches(spark, f"{folder}/j").select("id", "seq", "a", "b")
    assert sorted((tuple(r) for r in joined.collect()), key=lambda r: r[1]) == first_arrival_by_hand(events)
    summed = runner.read_batches(spark, f"{folder}/t").select("id", "seq", "total")
    assert sorted(tuple(r) for r in summed.collect()) == sorted(expected)


def test_running_total_forgets_idle_keys(spark, feed, folder):
    lines = feed("lines", "id int, seq int, v int")
    for seq, at in enumerate((0.0, 4.0, 20.0)):
        lines.add({"id": 1, "seq": seq, "v": 1}, {"id": None, "seq": seq, "v": 10})
        query = carried.start_running_total(
            lines.stream(), "id", "seq", "v", f"{folder}/t", f"{folder}/c", "total", 2, ttl_seconds=5.0, clock=lambda: at
        )
        runner.finish(query)
    found = sorted((r["seq"], r["id"] or 0, r["total"]) for r in runner.read_batches(spark, f"{folder}/t").collect())
    assert found == [(0, 0, 10), (0, 1, 1), (1, 0, 20), (1, 1, 2), (2, 0, 10), (2, 1, 1)]


@pytest.mark.parametrize("salting", [Salting(1), Salting(3)])
def test_lookup_sees_the_table_of_the_moment(spark, feed, run, rows, folder, salting):
    scores = feed("scores", "stu_no int, score int")
    dim = f"{folder}/dim"

    def save(*students):
        spark.createDataFrame(list(students), "stu_no int, stu_name string").write.mode("overwrite").json(dim)

    def build():
        table = spark.read.schema("stu_no int, stu_name string").json(dim)
        return lookup.lookup_join(scores.stream(), table, ["stu_no"], salting=salting).select("stu_no", "score", "stu_name")

    save((1, "v1"))
    scores.add({"stu_no": 1, "score": 10}, {"stu_no": 2, "score": 20})
    assert rows(run(build())) == [(1, 10, "v1"), (2, 20, None)]
    save((1, "v2"), (2, "v2"))
    scores.add({"stu_no": 1, "score": 11})
    assert rows(run(build())) == [(1, 10, "v1"), (1, 11, "v2"), (2, 20, None)]


def test_lookup_sees_files_that_come_while_it_runs(spark, feed, folder):
    scores, dim, out = feed("scores", "stu_no int"), f"{folder}/dim", f"{folder}/out"

    def save(*students):
        spark.createDataFrame(list(students), "stu_no int, stu_name string").write.mode("append").parquet(dim)

    save((1, "a"))
    query = lookup.start_lookup(
        scores.stream(), lambda: spark.read.schema("stu_no int, stu_name string").parquet(dim), ["stu_no"], out, f"{folder}/c",
        trigger={"processingTime": "100 milliseconds"},
    )
    try:
        scores.add({"stu_no": 1}, {"stu_no": 2})
        query.processAllAvailable()
        save((2, "b"))
        scores.add({"stu_no": 2})
        query.processAllAvailable()
    finally:
        query.stop()
    found = {(r["batch"], r["stu_no"], r["stu_name"]) for r in runner.read_batches(spark, out).collect()}
    assert found == {(0, 1, "a"), (0, 2, None), (1, 2, "b")}


def test_salting_belongs_to_the_checkpoint(spark, folder):
    chosen = Salting(4, ((7, 2), (9, 3)))
    for stored, path in ((chosen, "a"), (Salting(3), "b"), (Salting(4, ()), "c")):
        assert kept_with(spark, f"{folder}/{path}", lambda: stored) == stored
        assert kept_with(spark, f"{folder}/{path}", lambda: Salting(99)) == stored


def test_retracting_sums(spark, feed, folder):
    changes = feed("changes", "_op string, k string, v int")
    changes.add({"_op": "+I", "k": "a", "v": 5}, {"_op": "+I", "k": "b", "v": 7})
    changes.add({"_op": "-D", "k": "a", "v": 5})
    sums = aggregates.retracting(changes.stream(), ["k"], total="v")
    runner.finish(runner.start_batches(sums, f"{folder}/out", f"{folder}/checkpoint", "update"))
    found = sorted((r["batch"], r["_op"], r["k"], r["total"]) for r in runner.read_batches(spark, f"{folder}/out").collect())
    assert found == [(0, "+I", "a", 5), (0, "+I", "b", 7), (1, "-D", "a", 0)]


def test_cached_lookup_reads_again_after_its_time(spark, feed, folder):
    scores = feed("scores", "stu_no int")
    loads = []
    times = iter([0.0, 10.0, 31.0])

    def load():
        loads.append(len(loads) + 1)
        return spark.createDataFrame([(1, f"v{len(loads)}")], "stu_no int, stu_name string")

    for _ in range(3):
        scores.add({"stu_no": 1})
    query = lookup.start_cached_lookup(
        scores.stream(), load, ["stu_no"], f"{folder}/out", f"{folder}/checkpoint", 30, clock=lambda: next(times)
    )
    runner.finish(query)
    out = {(r["batch"], r["stu_name"]) for r in runner.read_batches(spark, f"{folder}/out").collect()}
    assert out == {(0, "v1"), (1, "v1"), (2, "v2")} and len(loads) == 2


def test_messages_to_files_and_back(spark, feed, run, rows, folder):
    scores = feed("scores", "stu_no int, stu_name string")
    scores.add({"stu_no": 1, "stu_name": "ä\n,"}, {"stu_no": 2})
    path = f"{folder}/messages"
    query = sink_messages.write_messages(
        sink_messages.to_json_value(scores.stream()), {}, f"{folder}/c1", "text", path, runner.AVAILABLE_NOW
    )
    runner.finish(query)
    back = messages.decode_json(messages.message_stream(spark, {}, "text", path), scores.schema, strict=True)
    assert rows(run(back)) == [(1, "ä\n,"), (2, None)]


def test_change_stream_with_a_schema_made_at_run_time(spark, run, rows, folder):
    os.makedirs(f"{folder}/cdc")
    with open(f"{folder}/cdc/1", "w") as handle:
        for op, before, after in (("c", None, {"id": 1, "name": "a"}), ("u", {"id": 1, "name": "a"}, {"id": 1, "name": "b"})):
            handle.write(json.dumps({"op": op, "before": before, "after": after}) + "\n")
    stream = changelog.change_stream(spark, {}, {"id": "int", "name": "string"}, "text", f"{folder}/cdc")
    assert rows(changelog.materialize(run(stream))) == [(1, "b")]
    typed = messages.json_stream(spark, {}, "op string", "text", f"{folder}/cdc")
    assert rows(run(typed, "typed")) == [("c",), ("u",)]


def test_rate_limit_cuts_the_input_into_micro_batches(spark, feed, folder):
    lines = feed("lines", "k int, v int")
    for _ in range(4):
        lines.add(*[{"k": 1, "v": 1} for _ in range(100)])
    size = os.path.getsize(f"{lines.path}/00001.json")
    stream = spark.readStream.schema(lines.schema).option("maxBytesPerTrigger", str(size)).json(lines.path)
    sums = aggregates.group_sum(stream, ["k"], "v", "total")
    runner.finish(runner.start_batches(sums, f"{folder}/out", f"{folder}/checkpoint"))
    assert sorted(r["total"] for r in runner.read_batches(spark, f"{folder}/out").collect()) == [100, 200, 300, 400]


def test_console(spark, feed, folder, capfd):
    scores = feed("scores", "stu_no int")
    scores.add({"stu_no": 4711})
    query = sink_messages.print_rows(scores.stream(), checkpoint=f"{folder}/c", trigger=runner.AVAILABLE_NOW)
    runner.finish(query)
    assert query.lastProgress["numInputRows"] == 1
    sink_messages.print_rows(spark.createDataFrame([(42,)], "n int"))
    assert "42" in capfd.readouterr().out


@pytest.fixture
def breaking(monkeypatch):
    """Let one call of a method fail when it has done its work, as if the driver were lost there."""

    def arm(owner, name, call):
        whole, calls = getattr(owner, name), iter(range(1, 1000))

        def step(*args, **options):
            result = whole(*args, **options)
            if next(calls) == call:
                raise RuntimeError("lost here")
            return result

        monkeypatch.setattr(owner, name, step)

    return arm


def _resumed(start):
    """Run a stream to its end, starting it again when it fails; gives the number of failures."""
    for failures in range(5):
        try:
            runner.finish(start())
            return failures
        except StreamingQueryException:
            pass
    raise AssertionError("fails again and again")


@pytest.mark.parametrize("call", [1, 4, 5])
def test_delta_join_repeats_a_micro_batch_that_failed(spark, feed, folder, breaking, monkeypatch, call):
    monkeypatch.setattr(kept, "FOLDED", 2)
    left, right = feed("left", "k int, a int"), feed("right", "k int, b string")
    for part in range(4):
        left.add(*[{"k": (part + i) % 5, "a": part * 10 + i} for i in range(4)])
        right.add(*[{"k": (2 * part + i) % 6, "b": f"{part}{i}"} for i in range(3)])
    # calls alternate between the changes of the two sides; before the second one or between two is a fold
    breaking(kept.KeptRows, "_save", call)

    def start():
        return delta_join.start_changelog_join(
            left.stream(), right.stream(), ["k"], f"{folder}/out", f"{folder}/checkpoint", "full", buckets=2
        )

    assert _resumed(start) == 1
    got = changelog.materialize(runner.read_batches(spark, f"{folder}/out").drop("batch"))
    read = [spark.read.schema(f.schema).json(f.path) for f in (left, right)]
    expected = read[0].join(read[1], "k", "full").select("k", "a", "b")
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


@pytest.mark.parametrize("call", [1, 3])
def test_carried_totals_repeat_a_micro_batch_that_failed(spark, feed, folder, breaking, monkeypatch, call):
    monkeypatch.setattr(kept, "FOLDED", 2)
    lines = feed("lines", "id int, seq int, v int")
    totals, expected = {}, []
    for seq in range(12):
        if seq % 3 == 0:
            lines.add(*[{"id": (seq + i) % 2, "seq": seq + i, "v": seq + i} for i in range(3)])
        totals[seq % 2] = totals.get(seq % 2, 0) + seq
        expected.append((seq, totals[seq % 2]))
    breaking(kept.KeptRows, "_save", call)

    def start():
        return carried.start_running_total(lines.stream(), "id", "seq", "v", f"{folder}/t", f"{folder}/c", "total", 2, buckets=2)

    assert _resumed(start) == 1
    found = runner.read_batches(spark, f"{folder}/t").select("seq", "total")
    assert sorted(tuple(r) for r in found.collect()) == expected


@pytest.mark.parametrize("writer", ["append", "batches", "messages", "lookup", "ordered"])
def test_writers_repeat_a_micro_batch_that_failed(spark, feed, folder, writer):
    lines = feed("lines", "v int, ts timestamp")
    for part in range(4):
        lines.add(*[{"v": part * 10 + i, "ts": f"2024-01-01 0{part}:0{i}:00"} for i in range(10)])
    mended = f"{folder}/mended"

    @F.udf("int")
    def fragile(v):
        if v == 15 and not os.path.exists(mended):
            raise ValueError("lost here")
        return v

    def start():
        rows = lines.stream().repartition(4).withColumn("v", fragile("v"))
        out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"
        if writer == "append":
            return runner.start_append(rows, out, checkpoint)
        if writer == "batches":
            return runner.start_batches(rows, out, checkpoint, "append")
        if writer == "messages":
            return sink_messages.write_messages(sink_messages.to_json_value(rows.select("v")), {}, checkpoint, "text", out, runner.AVAILABLE_NOW)
        if writer == "lookup":
            return lookup.start_lookup(rows, lambda: spark.range(50).selectExpr("CAST(id AS int) AS v", "id * 2 AS twice"), ["v"], out, checkpoint)
        return ordering.start_ordered(rows, "ts", out, checkpoint, "10 seconds", "1 minute")

    with pytest.raises(StreamingQueryException):
        runner.finish(start())
    open(mended, "w").close()
    runner.finish(start())
    if writer == "messages":
        found = [json.loads(r["value"])["v"] for r in spark.read.schema("value string").format("text").load(f"{folder}/out").collect()]
    else:
        found = [r["v"] for r in spark.read.parquet(f"{folder}/out").select("v").collect()]
    # the last minutes wait for later rows in an ordered stream
    assert sorted(found) == [v for v in range(40) if writer != "ordered" or v < max(found) + 1]
    assert writer != "ordered" or max(found) >= 37
