"""Operators on bounded tables, against values worked out by hand or by brute force."""

import random
from collections import defaultdict
from datetime import datetime as dt

import pytest
from pyspark.errors import PythonException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.functions import aggregate, lifecycle, registry, scalar
from millrace.operators import aggregates, joins, lateral, ordering, projection, running, windows
from millrace.operators.salting import Salting, find_hot_keys
from millrace.sinks import messages as sink_messages
from millrace.sinks import tables as sink_tables
from millrace.sources import changelog, jdbc, messages

ACCOUNTING = [(1, 100, 20), (1, 200, 50), (2, 50, None), (3, None, 100), (4, None, None)]
INCOME = [
    (10, dt(2024, 1, 1)), (20, dt(2024, 1, 1, 0, 59, 59)), (30, dt(2024, 1, 1, 1)), (40, dt(2024, 1, 1, 5, 30)),
    (50, dt(2024, 1, 2, 0, 10)),
]


def accounting(spark):
    return spark.createDataFrame(ACCOUNTING, "uid int, income int, expense int")


def income(spark):
    return spark.createDataFrame(INCOME, "amount int, ts timestamp_ntz")


# ---- projection and functions

def test_filter_drops_null_and_keeps_three_valued_logic(spark, rows):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 3), (2, 2, 2), (3, 1, 3), (None, 2, 9), (1, None, 9)], "stu_no int, sub_no int, score int")
    assert rows(projection.keep(df, "stu_no = 1", "sub_no <> 1")) == [(1, 2, 3)]
    assert rows(projection.keep(df, "stu_no <> 1", "sub_no <> 1")) == [(2, 2, 2)]


def test_explain_text(spark):
    text = projection.explain_text(accounting(spark).where("uid = 1"))
    assert "Physical Plan" in text and "uid" in text


def test_insert_columns(spark, rows):
    sink = {"stu_no": "int", "stu_name": "string", "sub_no": "int", "score": "int"}
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    out = projection.insert_columns(df, sink, ["stu_no", "sub_no", "score"])
    assert rows(out) == [(1, None, 2, 3)] and dict(out.dtypes)["stu_no"] == "int"
    with pytest.raises(ValueError):
        projection.insert_columns(df, sink, ["stu_no"])
    with pytest.raises(ValueError):
        projection.insert_columns(df, sink, ["stu_no", "sub_no", "other"])


def test_balance_functions(spark, rows):
    registry.register_all(spark)
    df = accounting(spark)
    expected = [(1, 80), (1, 150), (2, 50), (3, -100), (4, 0)]
    assert rows(df.selectExpr("uid", "calc_bal(income, expense)")) == expected
    assert rows(df.select("uid", scalar.calc_bal("income", "expense"))) == expected
    totals = [(1, 230), (2, 50), (3, -100), (4, 0)]
    assert rows(df.groupBy("uid").agg(aggregate.calc_total_bal("income", "expense"))) == totals
    assert rows(aggregate.apply_aggregate(df.repartition(3), ["uid"], aggregate.TotalBalance(), ["income", "expense"], "t")) == totals


def test_sql_scalar_function_is_inlined(spark):
    registry.register_all(spark)
    plan = projection.explain_text(accounting(spark).selectExpr("calc_bal(income, expense) AS b"))
    assert "coalesce" in plan and "EvalPython" not in plan


def test_own_aggregate_with_retraction_and_null_key(spark, rows):
    df = spark.createDataFrame(
        [("+I", None, 5, 1), ("+I", 1, 100, 20), ("+I", 1, 7, 7), ("-D", 1, 100, 20), ("+I", None, 5, None)],
        "_op string, uid int, income int, expense int",
    )
    out = aggregate.apply_aggregate(df, ["uid"], aggregate.TotalBalance(), ["income", "expense"], "t", op="_op")
    assert rows(out) == [(1, 0), (None, 9)]


def test_own_aggregate_of_large_and_odd_keys(spark):
    big, nan = 2**53, float("nan")
    df = spark.createDataFrame([(big, 1), (big + 1, 2), (None, 4), (big, None), (None, big + 1)], "k bigint, a bigint").withColumn("b", F.lit(0))
    out = aggregate.apply_aggregate(df.coalesce(1), ["k"], aggregate.TotalBalance(), ["a", "b"], "t")
    assert {r.k: r.t for r in out.collect()} == {big: 1, big + 1: 2, None: big + 5}
    odd = spark.createDataFrame([(nan, 1), (nan, 2), (None, 4), (0.0, 8), (-0.0, 16), (None, 32)], "k double, a bigint").withColumn("b", F.lit(0))
    out = aggregate.apply_aggregate(odd.repartition(3), ["k"], aggregate.TotalBalance(), ["a", "b"], "t")
    assert sorted((str(r.k), r.t) for r in out.collect()) == [("0.0", 24), ("None", 36), ("nan", 3)]
    typed = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', 1.25BD, 1L), (DATE'2024-01-01', 1.25BD, 2L), (NULL, 1.25BD, 4L), (DATE'2024-01-01', NULL, 8L) t(d, m, a)")
    out = aggregate.apply_aggregate(typed.withColumn("b", F.lit(0)), ["d", "m"], aggregate.TotalBalance(), ["a", "b"], "t")
    assert sorted(r.t for r in out.collect()) == [3, 4, 8] and out.schema["m"].dataType == typed.schema["m"].dataType
    assert aggregate.apply_aggregate(df.limit(0), ["k"], aggregate.TotalBalance(), ["a", "b"], "t").count() == 0


def test_own_aggregate_adds_up_beyond_64_bits(spark, rows):
    big = 2**62
    df = spark.createDataFrame([(1, big, big - 1)] * 5 + [(2, -big, None)] + [(3, None, None)], "k int, a bigint, b bigint")
    for parts in (1, 3):
        out = aggregate.apply_aggregate(df.repartition(parts), ["k"], aggregate.TotalBalance(), ["a", "b"], "t")
        assert rows(out) == [(1, 5), (2, -big), (3, 0)]
    # a total that is no bigint fails instead of wrapping around to one
    over = spark.createDataFrame([(1, big, 0)] * 5, "k int, a bigint, b bigint").coalesce(1)
    with pytest.raises(PythonException, match=f"total balance {5 * big} is out of range for bigint"):
        aggregate.apply_aggregate(over, ["k"], aggregate.TotalBalance(), ["a", "b"], "t").collect()


def test_own_aggregate_keeps_one_accumulator_per_task(spark):
    df = spark.range(0, 40_000, 1, 4).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("a"), F.lit(0).alias("b"))
    out = aggregate.apply_aggregate(df, ["k"], aggregate.TotalBalance(), ["a", "b"], "t")
    assert out.collect()[0]["t"] == sum(range(40_000))


def test_a_hot_key_is_copied_no_more_than_its_share_asks(spark):
    facts = spark.range(0, 1000).select(F.when(F.col("id") < 300, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    dim = facts.select("k").distinct()
    salting = find_hot_keys(facts, ["k"])  # four partitions: a fair share is 250 rows, the hot key has 300
    assert [n for _, n in salting.hot] == [2]
    assert salting.copy(dim, ["k"]).count() == dim.count() + 1
    assert joins.regular_join(facts, dim, ["k"], "left", salting=salting).count() == 1000


def test_quotients(spark, rows):
    df = spark.createDataFrame([(3,), (-3,), (20,), (None,)], "n int")
    assert rows(df.select(scalar.quotient("n"))) == [(-3,), (0,), (3,), (None,)]
    assert rows(df.groupBy().agg(aggregate.sum_of_quotients("n"))) == [(0,)]
    registry.register_all(spark)
    assert rows(df.selectExpr("func1(n)")) == [(-3,), (0,), (3,), (None,)]
    text = spark.createDataFrame([("7",), ("14",), ("-90",)], "value string")
    assert rows(text.select(scalar.distance_quotient("value"))) == [(0,), (2,), (3,)]


@pytest.mark.parametrize("bad", ["10", "x"])
def test_map_chain_fails(spark, bad):
    df = spark.createDataFrame([(bad,)], "value string")
    with pytest.raises(Exception, match="zero|CAST_INVALID"):
        df.select(scalar.distance_quotient("value")).collect()


def test_zero_divisor_fails(spark):
    with pytest.raises(Exception, match="zero|ZERO"):
        spark.createDataFrame([(0,)], "n int").select(scalar.quotient("n")).collect()


@pytest.mark.parametrize("function", ["get_detail", "get_detail_py"])
def test_lateral_left_join(spark, rows, function):
    registry.register_all(spark)
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "uid int")
    out = lateral.lateral_left_join(users, function, ["uid"], ["income", "expense"])
    assert rows(out) == [(1, 100, 20), (1, 200, 50), (2, 50, None), (3, None, 100), (4, None, None)]


def test_resource_is_opened_and_closed_per_task(spark, folder):
    def open_():
        return {"factor": 3}

    def close(resource):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as handle:
            handle.write("closed")

    df = spark.range(0, 100, 1, 2)
    out = lifecycle.map_with_resource(df, open_, lambda r, b: b.assign(id=b.id * r["factor"]), "id long", close)
    assert out.agg(F.sum("id")).collect()[0][0] == 3 * sum(range(100))
    import os

    assert len(os.listdir(folder)) == 2


# ---- joins

def scores_and_students(spark):
    scores = spark.createDataFrame([(1, 1, 90), (1, 2, 80), (2, 1, 70), (9, 1, 60), (None, 1, 50)], "stu_no int, sub_no int, score int")
    students = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "n")], "stu_no int, stu_name string")
    return scores, students


@pytest.mark.parametrize("salting", [Salting(1), Salting(3)])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_regular_join(spark, rows, how, salting):
    scores, students = scores_and_students(spark)
    expected = scores.join(students, "stu_no", how).select("stu_no", "sub_no", "score", "stu_name")
    assert rows(joins.regular_join(scores, students, ["stu_no"], how, salting=salting)) == rows(expected)


@pytest.mark.parametrize("salting", [Salting(1), Salting(3)])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_regular_join_with_condition(spark, rows, how, salting):
    random.seed(3)
    left = [(random.choice([1, 1, 1, 2, None]), random.randrange(9)) for _ in range(60)]
    right = [(random.choice([1, 2, 3, None]), random.randrange(9)) for _ in range(20)]
    l = spark.createDataFrame(left, "k int, a int")
    r = spark.createDataFrame(right, "k int, b int")
    out = joins.regular_join(l, r, ["k"], how, F.col("a") > F.col("b") + 3, salting)
    expected = [(lk, a, b) for lk, a in left for rk, b in right if lk == rk and lk is not None and a > b + 3]
    if how in ("left", "full"):
        expected += [(k, a, None) for k, a in left if not any(k == rk and k is not None and a > b + 3 for rk, b in right)]
    if how in ("right", "full"):
        expected += [(k, None, b) for k, b in right if not any(k == lk and k is not None and a > b + 3 for lk, a in left)]
    key = lambda row: [(v is None, v or 0) for v in row]
    assert sorted(rows(out), key=key) == sorted(expected, key=key)


def test_hot_keys_are_found_and_split(spark, rows):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("v"))
    salting = find_hot_keys(facts, ["k"], salts=5)
    assert len(salting.hot) == 1
    spread = salting.spread(facts, ["k"], facts.columns)
    groups = {r["k"]: r["n"] for r in spread.groupBy("k").agg(F.countDistinct("_salt").alias("n")).collect()}
    assert groups.pop(7) == 5 and set(groups.values()) == {1}
    dim = spark.createDataFrame([(7, "hot"), (8, "cold")], "k int, name string")
    assert salting.copy(dim, ["k"]).groupBy("k").count().collect() and salting.copy(dim, ["k"]).count() == 6
    out = joins.regular_join(facts, dim, ["k"], "full", salting=salting)
    assert rows(out) == rows(facts.join(dim, "k", "full").select("k", "v", "name"))


@pytest.mark.parametrize("salting", [Salting(1), Salting(4)])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("lower,upper", [(-5, -1), (0, 0), (-2, 7)])
def test_band_join(spark, rows, how, lower, upper, salting):
    random.seed(lower + 10 * upper)
    left = [(random.randrange(-40, 60), i) for i in range(60)]
    right = [(random.randrange(-60, 40), i) for i in range(60)]
    l = spark.createDataFrame(left, "x int, a int")
    r = spark.createDataFrame(right, "y int, b int")
    out = joins.band_join(l, r, "x", "y", lower, upper, how, condition=F.col("a") != F.col("b"), salting=salting)
    match = lambda x, a, y, b: lower <= y - x <= upper and a != b
    expected = [(x, a, y, b) for x, a in left for y, b in right if match(x, a, y, b)]
    if how in ("left", "full"):
        expected += [(x, a, None, None) for x, a in left if not any(match(x, a, y, b) for y, b in right)]
    if how in ("right", "full"):
        expected += [(None, None, y, b) for y, b in right if not any(match(x, a, y, b) for x, a in left)]
    key = lambda row: [(v is None, v or 0) for v in row]
    assert sorted(rows(out), key=key) == sorted(expected, key=key)


def test_join_plans_have_no_cross_product(spark):
    l = spark.range(100).select(F.col("id").alias("x"))
    r = spark.range(100).select(F.col("id").alias("y"))
    plan = projection.explain_text(joins.band_join(l, r, "x", "y", 0, 3, "full"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_joins_refuse_bad_arguments(spark):
    scores, students = scores_and_students(spark)
    for call in (
        lambda: joins.regular_join(scores, students, []),
        lambda: joins.regular_join(scores, students, ["stu_no"], "semi"),
        lambda: joins.regular_join(scores, scores, ["stu_no"]),
        lambda: joins.band_join(scores, students, "score", "stu_no", 3, 1),
    ):
        with pytest.raises(ValueError):
            call()


def test_enrich_gives_one_row_per_input_and_last_duplicate(spark, rows):
    scores, _ = scores_and_students(spark)
    dim = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "x", 1), (None, "n", 1)], "stu_no int, stu_name string, version int")
    out = joins.enrich(scores, dim, "stu_no", ["version"], ["stu_name"])
    assert rows(out) == [(1, 1, 90, "new"), (1, 2, 80, "new"), (2, 1, 70, None), (9, 1, 60, None), (None, 1, 50, None)]


# ---- order-dependent operators

@pytest.mark.parametrize("blocks", [1, 7])
def test_first_arrival_join(spark, rows, blocks):
    data1 = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 5, "c"), (2, 8, "z"), (2, 9, "w")], "id int, seq int, name string")
    data2 = spark.createDataFrame([(1, 3, 5), (1, 4, 6), (1, 6, 7), (2, 7, 9)], "id int, seq int, score int")
    out = running.first_arrival_join(data1, data2, "id", "seq", blocks)
    assert rows(out, "id", "name", "score") == [(1, "b", 5), (1, "b", 6), (1, "c", 7), (2, "w", 9), (2, "z", 9)]


def first_arrival_by_hand(events):
    first, buffer, out = {}, {}, []
    for key, seq, side, value in sorted(events, key=lambda e: e[1]):
        first.setdefault(key, side)
        if side == first[key]:
            buffer[key] = value
        else:
            out.append((key, seq, value, buffer[key]) if side == "l" else (key, seq, buffer[key], value))
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("blocks", [2, 16])
def test_order_dependent_operators_with_a_hot_key(spark, rows, blocks):
    random.seed(blocks)
    events = [(random.choice([1, 1, 1, 2, 3, 4]), i, random.choice("lr"), random.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(events, "id int, seq int, side string, v int")
    l = df.where("side = 'l'").selectExpr("id", "seq", "v AS a")
    r = df.where("side = 'r'").selectExpr("id", "seq", "v AS b")
    out = running.first_arrival_join(l, r, "id", "seq", blocks)
    assert sorted([tuple(x) for x in out.collect()], key=lambda x: x[1]) == first_arrival_by_hand(events)

    totals, expected = defaultdict(int), []
    for key, seq, _, v in events:
        totals[key] += v
        expected.append((key, seq, totals[key]))
    found = running.running_total(df.select("id", "seq", "v"), ["id"], "seq", "v", "total", blocks).select("id", "seq", "total")
    assert sorted(tuple(x) for x in found.collect()) == sorted(expected)


def test_blocks_split_a_hot_key_evenly(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"), F.col("id").alias("seq"))
    sizes = [r["count"] for r in running.with_block(df, "seq", 8).groupBy("k", "_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * 1000


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "decimal(20,3)"])
def test_blocks_follow_every_kind_of_order(spark, kind):
    numbers = spark.range(1, 400).select(F.lit(1).alias("k"), F.col("id").alias("n"))
    if kind.startswith("decimal"):
        column = F.col("n").cast(kind)
    else:
        column = (F.lit("1969-11-01").cast("date") + F.col("n").cast("int")).cast(kind)
    df = numbers.withColumn("at", column)
    out = running.running_total(df, ["k"], "at", "n", "t", 5).collect()
    assert all(r["t"] == r["n"] * (r["n"] + 1) // 2 for r in out) and len(out) == 399
    bounds = running.with_block(df, "at", 5).groupBy("_block").agg(F.min("n"), F.max("n")).orderBy("_block").collect()
    assert len(bounds) == 5 and all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_user_functions_are_registered(spark, rows):
    import pandas as pd

    @F.pandas_udf("int")
    def double(values: pd.Series) -> pd.Series:
        return values * 2

    registry.register_function(spark, "double_it", double)
    assert rows(spark.createDataFrame([(3,), (4,)], "n int").selectExpr("double_it(n)")) == [(6,), (8,)]


def test_local_time_does_not_depend_on_the_session_zone(spark):
    from millrace.session import scoped_conf

    for zone in ("UTC", "America/New_York"):
        with scoped_conf(spark, spark__sql__session__timeZone=zone):
            df = spark.sql("SELECT timestamp_seconds(1704067200) AS ts").select(windows.local_time("ts", "Asia/Shanghai").alias("l"))
            assert df.collect()[0]["l"] == dt(2024, 1, 1, 8)


def test_running_total_of_null_values_and_null_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, None), (None, 3, 1), (1, 4, None), (1, 5, 2)], "k int, seq int, v int")
    out = running.running_total(df, ["k"], "seq", "v", "t", 3).orderBy("seq").select("t").collect()
    assert [r["t"] for r in out] == [5, 5, 6, None, 2]


def test_order_by_time(spark):
    df = spark.createDataFrame([(dt(2024, 1, d), d) for d in (3, 1, 2)], "ts timestamp_ntz, n int")
    assert [r["n"] for r in ordering.order_by_time(df, "ts").collect()] == [1, 2, 3]


# ---- windows

def test_tumble_hop_cumulate(spark, rows):
    total = [F.sum("amount").alias("t")]
    day = lambda d, h: dt(2024, 1, d, h)
    tumbled = windows.tumble(income(spark), "ts", "1 hour", total)
    assert rows(tumbled, "window_start", "t") == [(day(1, 0), 30), (day(1, 1), 30), (day(1, 5), 40), (day(2, 0), 50)]

    merged = {"t": ("sum", "amount"), "n": ("count", "amount"), "top": ("max", "amount")}
    every = [F.sum("amount").alias("t"), F.count("amount").alias("n"), F.max("amount").alias("top")]
    for slide, size in (("10 minutes", "1 hour"), ("25 minutes", "1 hour")):
        whole = rows(windows.hop(income(spark), "ts", slide, size, every))
        assert rows(windows.hop(income(spark), "ts", slide, size, merged)) == whole
    hopped = {r["window_start"]: r["t"] for r in windows.hop(income(spark), "ts", "10 minutes", "1 hour", total).collect()}
    expected = defaultdict(int)
    for amount, ts in INCOME:
        last = ts.replace(minute=ts.minute // 10 * 10, second=0)
        for k in range(6):
            expected[dt.fromtimestamp(last.timestamp() - 600 * k)] += amount
    assert hopped == dict(expected)

    grown = windows.cumulate(income(spark), "ts", "1 hour", "1 day", {"t": ("sum", "amount"), "n": ("count", "amount"), "low": ("min", "amount")})
    found = {(r["window_start"], r["window_end"]): (r["t"], r["n"], r["low"]) for r in grown.collect()}
    ends = [day(1, h) for h in range(1, 24)] + [day(2, 0)]
    assert {e: found[(day(1, 0), e)][0] for e in ends} == {e: 30 if i < 1 else 60 if i < 5 else 100 for i, e in enumerate(ends)}
    assert len(found) == 48 and found[(day(2, 0), dt(2024, 1, 2, 1))] == (50, 1, 50)
    assert found[(day(1, 0), day(2, 0))] == (100, 4, 10)


def test_window_arguments(spark):
    with pytest.raises(ValueError):
        windows.cumulate(income(spark), "ts", "7 hours", "1 day", {"t": ("sum", "amount")})
    with pytest.raises(ValueError):
        windows.cumulate(income(spark), "ts", "1 hour", "1 day", {"t": ("avg", "amount")})
    with pytest.raises(ValueError):
        windows.interval_ms("soon")
    assert windows.interval_ms("1 hour 30 minutes") == 5_400_000


def test_tumble_rows_needs_no_shuffle(spark, rows):
    out = windows.tumble_rows(income(spark), "ts", "1 hour")
    assert "Exchange" not in projection.explain_text(out)
    first = out.where("amount = 20").collect()[0]
    assert (first["window_start"], first["window_end"], first["window_time"]) == (
        dt(2024, 1, 1), dt(2024, 1, 1, 1), dt(2024, 1, 1, 0, 59, 59, 999000),
    )


def test_local_day_windows(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01 15:59:59"), (2, "2024-01-01 16:00:00")], "amount int, text string").selectExpr(
        "amount", "cast(text AS timestamp) AS ts"
    )
    offset = windows.day_offset("Asia/Shanghai", (2024, 2024))
    assert offset == "57600 seconds"
    assert rows(windows.tumble(df, "ts", "1 day", [F.sum("amount").alias("t")], offset=offset), "t") == [(1,), (2,)]
    with pytest.raises(ValueError):
        windows.day_offset("Europe/Berlin", (2024, 2024))


def test_processing_time(spark):
    out = windows.tumble_by_processing_time(income(spark).drop("ts"), "1 minute", [F.sum("amount").alias("t")])
    assert sum(r["t"] for r in out.collect()) == 150
    assert dict(windows.with_processing_time(income(spark).drop("ts")).dtypes)["ts"] == "timestamp"


# ---- changelogs, messages, tables

ENVELOPES = [
    '{"op":"c","after":{"stu_no":1,"stu_name":"a"}}',
    '{"op":"u","before":{"stu_no":1,"stu_name":"a"},"after":{"stu_no":1,"stu_name":"b"}}',
    '{"op":"d","before":{"stu_no":1,"stu_name":"b"}}',
    '{"op":"r","after":{"stu_no":2,"stu_name":"x"}}',
    '{"op":"c","before":null,"after":{"stu_no":2,"stu_name":"y"}}',
    None,
]


def changes(spark):
    messages_df = spark.createDataFrame(list(enumerate(ENVELOPES)), "seq int, value string")
    return changelog.decode_changes(messages_df, "stu_no int, stu_name string", carry=["seq"])


def test_decode_and_fold_a_changelog(spark, rows):
    df = changes(spark)
    assert rows(df, "seq", "_part", "_op", "stu_no", "stu_name") == [
        (0, 1, "+I", 1, "a"), (1, 0, "-D", 1, "a"), (1, 1, "+I", 1, "b"), (2, 0, "-D", 1, "b"), (3, 1, "+I", 2, "x"), (4, 1, "+I", 2, "y"),
    ]
    assert rows(changelog.materialize(df, ignore=["seq", "_part"]), "stu_no", "stu_name") == [(2, "x"), (2, "y")]
    assert rows(changelog.latest_by_key(df, ["stu_no"], ["seq", "_part"])) == [(2, "y")]
    assert rows(aggregates.retractable(df, ["stu_no"], n=F.lit(1))) == [(2, 2)]


@pytest.mark.parametrize(
    "bad", ['{"op":"u","after":{"stu_no":1,"stu_name":"a"}}', '{"op":"x"}', '{"op":"c"}', "{", '{"op":"d","after":{"stu_no":1}}']
)
def test_bad_envelopes_fail(spark, bad):
    df = spark.createDataFrame([(bad,)], "value string")
    with pytest.raises(Exception):
        changelog.decode_changes(df, "stu_no int, stu_name string").collect()


def test_materialize_many_copies(spark):
    df = spark.range(10_000).select(F.lit("+I").alias("_op"), F.lit(1).alias("k"))
    assert changelog.materialize(df).count() == 10_000


def test_json_records(spark, rows):
    df = spark.createDataFrame([('{"id":1,"name":"a"}',), ('{"id":2}',)], "value string")
    assert rows(messages.decode_json(df, "id int, name string", strict=True)) == [(1, "a"), (2, None)]
    more = spark.createDataFrame([('{"id":1,"extra":2}',)], "value string")
    assert rows(messages.decode_json(more, "id int, name string")) == [(1, None)]
    with pytest.raises(Exception, match="unknown field"):
        messages.decode_json(more, "id int, name string", strict=True).collect()
    with pytest.raises(Exception):
        messages.decode_json(spark.createDataFrame([("{id",)], "value string"), "id int").collect()


def test_json_values_keep_null_fields(spark, rows):
    df = spark.createDataFrame([(1, None)], "stu_no int, stu_name string")
    assert rows(sink_messages.to_json_value(df)) == [('{"stu_no":1,"stu_name":null}',)]
    assert sink_messages.to_json_value(df, "stu_no").columns == ["key", "value"]


def test_connector_options():
    options = messages.kafka_source_options("t", "h:9092", "g")
    assert options == {"subscribe": "t", "kafka.bootstrap.servers": "h:9092", "startingOffsets": "latest", "kafka.group.id": "g"}
    assert sink_messages.kafka_sink_options("t", "h:9092") == {"topic": "t", "kafka.bootstrap.servers": "h:9092"}
    assert jdbc.jdbc_options("u", "t", "d", "n", "p") == {"url": "u", "dbtable": "t", "driver": "d", "user": "n", "password": "p"}
    assert jdbc.partition_options("id", 0, 99, 4)["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc.partition_options("id", 5, 1, 4)


def test_declared_schema(spark):
    df = jdbc.declared(spark.createDataFrame([(1, "a", 2)], "x long, y string, z int"), "y string, x int")
    assert df.dtypes == [("y", "string"), ("x", "int")]


def test_inline_rows_and_upsert(spark, rows):
    score = spark.sql("SELECT * FROM VALUES ('jenny', 'english', 78), ('tom', 'chinese', 90) AS t(stuname, subject, score)")
    updates = spark.createDataFrame([("tom", "maths", 60, 1), ("tom", "maths", 61, 2), ("ann", "art", 99, 1)], "stuname string, subject string, score int, seq int")
    out = sink_tables.upsert(score, updates, ["stuname"], ["seq"])
    assert rows(out) == [("ann", "art", 99), ("jenny", "english", 78), ("tom", "maths", 61)]


def test_observed_malformed_lines(spark, rows):
    from millrace.sources import delimited

    lines = spark.createDataFrame([("1,1,1",), ("1,2",), ("1,,3",), ("1,2,",), ("",)], "value string")
    seen = Observation("log")
    out = delimited.deserialize_columns(lines, "a int, b int, c int", observation=seen)
    assert rows(out) == [(1, 1, 1), (1, 2, None), (1, None, 3)]
    assert seen.get == {"lines": 5, "malformed": 2}
