"""Queries on streams. Their tables arrive in parts; after each delivery the stream is started, reads on from its
checkpoint and stops, and the query gives what it wrote in all its runs.

The SQL describes the result after the last micro-batch: windows that the watermark has not closed yet are not there.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import aggregates, joins, windows
from millrace.operators.salting import find_hot_keys, kept_with
from millrace.plans import batch
from millrace.plans import tables as t
from millrace.plans.batch import LOG_SCHEMA, Query
from millrace.session import fair_partitions, shared_folder
from millrace.sinks import messages as sink_messages
from millrace.sources import changelog, logtail, messages
from millrace.streaming import carried, changelog_band, changelog_join, delta_join, keyed, lookup, ordering, runner

STREAM: dict[str, tuple[Query, str]] = {}

def query(sql: str):
    def add(function: Query) -> Query:
        STREAM[function.__name__] = (function, sql)
        return function

    return add


def _in_time(sql: str) -> str:
    """Rows that come when their windows are closed are dropped."""
    return sql.replace("FROM events", f"FROM (SELECT * FROM events WHERE NOT {t.LATE_SQL}) AS events")


def _closed(sql: str) -> str:
    return f"SELECT * FROM ({_in_time(sql)}) WHERE window_end <= (SELECT max(ts) FROM events)"


def _windows(spark, sf_dir, build) -> DataFrame:
    """Windows over events that arrive in order of time, with late ones at the end."""
    arrivals = t.events_in_time(spark, sf_dir)

    def income(_checkpoint):
        return build(windows.with_watermark(t.zoned(t.income(arrivals.stream("events")), "ts"), "ts"))

    return t.zoneless(t.run_append(spark, arrivals, income), "window_start", "window_end")


# ---- sources

@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity, l_returnflag, CAST(l_partkey AS INTEGER) AS l_partkey "
    "FROM lineitem"
)
def log_tail_stream(spark, sf_dir):
    """Logs that come while the stream is stopped, in sub-folders; each run reads on from its checkpoint."""
    lines = batch.log_lines(t.table(spark, sf_dir, "lineitem"))
    root, folder = shared_folder(spark, "log"), shared_folder(spark, "stream")
    for part in range(t.PARTS):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(t.PARTS)) == part).write.text(f"{root}/part={part}")
        stream = logtail.read_log(spark, root, LOG_SCHEMA, mode="stream")
        runner.finish(runner.start_append(stream, f"{folder}/rows", f"{folder}/checkpoint"))
    return runner.read_append(spark, f"{folder}/rows", stream)


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_message_stream(spark, sf_dir):
    """Rows to JSON messages, and the messages back to typed rows."""
    arrivals = t.Arrivals(spark, t.PARTS, conversations=(t.table(spark, sf_dir, "conversations"), t.by_content("conv_id")))
    schema = "conv_id bigint, turn bigint, role string, text string"
    path = shared_folder(spark, "messages")

    def build(checkpoint):
        rows = sink_messages.to_json_value(arrivals.stream("conversations").select("conv_id", "turn", "role", "text"))
        runner.finish(sink_messages.write_messages(rows, {}, path + "-checkpoint", "text", path, runner.AVAILABLE_NOW))
        return messages.decode_json(messages.message_stream(spark, {}, "text", path), schema, strict=True)

    return t.run_append(spark, arrivals, build)


# ---- aggregates

@query(batch.GROUP_SUM_SQL)
def group_sum_stream(spark, sf_dir):
    """Updating result; the last update of a key is its value."""
    arrivals = t.events_in_order(spark, sf_dir)

    def start(path, checkpoint):
        sums = aggregates.group_sum(t.score(arrivals.stream("events")), ["stuname"], "score", "total_score")
        return runner.start_batches(sums, path, checkpoint, "update")

    updates = t.run_batches(spark, arrivals, start)
    return updates.groupBy("stuname").agg(F.max_by("total_score", "batch").alias("total_score"))


@query(f"""
SELECT segment, CAST(sum(balance) AS BIGINT) AS total FROM (
  SELECT c_mktsegment AS segment, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer WHERE c_mktsegment <> 'MACHINERY'
) GROUP BY segment
""")
def retraction_stream(spark, sf_dir):
    """Sums over a changelog whose changes come in later micro-batches; a key that has gone is taken back."""
    arrivals = _customer_messages(spark, sf_dir)

    def start(path, checkpoint):
        changes = changelog.decode_changes(arrivals.stream("messages"), t.DIM_SCHEMA)
        sums = aggregates.retracting(changes, ["segment"], total="balance")
        return runner.start_batches(sums, path, checkpoint, "update")

    updates = t.run_batches(spark, arrivals, start)
    last = updates.groupBy("segment").agg(F.max_by(F.struct("_op", "total"), "batch").alias("last"))
    return last.where(F.col("last._op") == changelog.INSERT).select("segment", "last.total")


@query(batch.RUNNING_SQL)
def running_total_stream(spark, sf_dir):
    arrivals = t.events_in_order(spark, sf_dir)

    def build(_checkpoint):
        events = arrivals.stream("events", t.KEYED_BATCH_BYTES).select("user_id", "event_id", t.cents("value").alias("amount"))
        return keyed.running_total(events, "user_id", "event_id", "amount").drop("amount")

    return t.run_append(spark, arrivals, build)


@query(batch.RUNNING_SQL)
def running_total_large_batches(spark, sf_dir):
    arrivals = t.events_in_order(spark, sf_dir)

    def start(path, checkpoint):
        events = arrivals.stream("events").select("user_id", "event_id", t.cents("value").alias("amount"))
        return carried.start_running_total(events, "user_id", "event_id", "amount", path, checkpoint, buckets=fair_partitions(spark))

    return t.run_batches(spark, arrivals, start).drop("amount", "batch")


# ---- windows and order

@query(_closed(batch.TUMBLE_SQL))
def tumble_stream(spark, sf_dir):
    return _windows(spark, sf_dir, lambda income: windows.tumble(income, "ts", "1 hour", batch.total()))


@query(_closed(batch.HOP_SQL))
def hop_stream(spark, sf_dir):
    return _windows(spark, sf_dir, lambda income: windows.hop(income, "ts", "10 minutes", "1 hour", {"total_amount": ("sum", "amount")}))


@query(_closed(batch.CUMULATE_SQL))
def cumulate_stream(spark, sf_dir):
    return _windows(
        spark, sf_dir, lambda income: windows.cumulate(income, "ts", "1 hour", "1 day", {"total_amount": ("sum", "amount")})
    )


@query("SELECT CAST(sum(CAST(round(value * 100) AS INTEGER)) AS BIGINT) AS total_amount FROM events")
def processing_time_tumble_stream(spark, sf_dir):
    """Windows by arrival hold every row once, whenever it arrived."""
    arrivals = t.events_in_order(spark, sf_dir)

    def start(path, checkpoint):
        by_window = windows.tumble_by_processing_time(t.income(arrivals.stream("events")), "1 minute", batch.total())
        return runner.start_batches(by_window, path, checkpoint, "update")

    updates = t.run_batches(spark, arrivals, start)
    last = updates.groupBy("window_start", "window_end").agg(F.max_by("total_amount", "batch").alias("total_amount"))
    return last.agg(F.sum("total_amount").alias("total_amount"))


@query(f"""
SELECT stuname, subject, score, ts, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS position FROM (
  SELECT CAST(user_id AS VARCHAR) AS stuname, event_type AS subject, CAST(round(value * 100) AS INTEGER) AS score, ts, event_id
  FROM events WHERE time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND
    AND NOT {t.LATE_SQL}
)
""")
def order_by_time_stream(spark, sf_dir):
    """The rows in the order in which the stream wrote them, counted through its micro-batches and files."""
    arrivals = t.events_in_time(spark, sf_dir)

    def start(path, checkpoint):
        scores = t.zoned(t.score(arrivals.stream("events")), "ts")
        return ordering.start_ordered(scores, "ts", path, checkpoint, "10 seconds", "1 minute", ties=["event_id"])

    rows = t.zoneless(ordering.with_position(t.run_batches(spark, arrivals, start)), "ts")
    return rows.select("stuname", "subject", "score", "ts", "position")


# ---- joins

def _scores_and_students(spark, sf_dir) -> t.Arrivals:
    scores, students = t.ods_score(t.table(spark, sf_dir, "orders")), t.dim_student(t.table(spark, sf_dir, "customer"))
    return t.Arrivals(
        spark, t.PARTS, scores=(scores, t.by_content("sub_no")), students=(students, t.by_content("stu_no"))
    )


@query(
    "SELECT o_custkey AS stu_no, c_name AS stu_name, o_orderkey AS sub_no, CAST(floor(o_totalprice) AS INTEGER) AS score "
    "FROM orders JOIN customer ON o_custkey = c_custkey"
)
def stream_join_inner(spark, sf_dir):
    """Hot keys are looked for in the first part and stay with the checkpoint."""
    arrivals = _scores_and_students(spark, sf_dir)

    def build(checkpoint):
        seen = spark.read.schema("stu_no bigint").parquet(f"{arrivals.folder}/scores")
        hot = kept_with(spark, checkpoint, lambda: find_hot_keys(seen, ["stu_no"]))
        joined = joins.regular_join(arrivals.stream("scores"), arrivals.stream("students"), ["stu_no"], salting=hot)
        return joined.select("stu_no", "stu_name", "sub_no", "score")

    return t.run_append(spark, arrivals, build)


@query(batch._theta_sql("INNER"))
def stream_join_theta(spark, sf_dir):
    arrivals = t.events_by_content(spark, sf_dir)

    def build(_checkpoint):
        purchases = batch._views_and_purchases(arrivals.stream("events"))[0]
        views = batch._views_and_purchases(arrivals.stream("events"))[1]
        return joins.band_join(
            purchases, views, "purchase_id", "view_id", -5, -1, condition=F.col("viewer") != F.col("buyer")
        )

    return t.run_append(spark, arrivals, build)


def _theta_changes(spark, sf_dir, how):
    """A delivery is one micro-batch, whatever its size: a bucket is bounded, and each micro-batch reads all of them."""
    arrivals = t.events_by_content(spark, sf_dir)

    def build(_checkpoint):
        purchases = batch._views_and_purchases(arrivals.stream("events"))[0]
        views = batch._views_and_purchases(arrivals.stream("events"))[1]
        return changelog_band.changelog_band_join(
            purchases, views, "purchase_id", "view_id", -5, -1, how,
            matches=lambda purchase, view: view.viewer != purchase.buyer,
            bucket_width=4096,  # numbers are unique, so a bucket has at most as many rows
        )

    return changelog.materialize(t.run_append(spark, arrivals, build))


@query(batch._theta_sql("LEFT"))
def stream_join_theta_left(spark, sf_dir):
    return _theta_changes(spark, sf_dir, "left")


@query(batch._theta_sql("RIGHT"))
def stream_join_theta_right(spark, sf_dir):
    return _theta_changes(spark, sf_dir, "right")


@query(batch._theta_sql("FULL"))
def stream_join_theta_full(spark, sf_dir):
    return _theta_changes(spark, sf_dir, "full")


def _interval_sql(how: str) -> str:
    of = "SELECT user_id, event_id AS {0}_id, ts AS {0}_ts FROM events WHERE event_type = '{0}'"
    return f"""
    SELECT coalesce(p.user_id, v.user_id) AS user_id, purchase_id, purchase_ts, view_id, view_ts
    FROM ({of.format("purchase")}) p {how} JOIN ({of.format("view")}) v
    ON p.user_id = v.user_id AND view_ts BETWEEN purchase_ts - INTERVAL 6 HOUR AND purchase_ts"""


def _purchases_and_views(spark, sf_dir, how):
    """Purchases with the views of the same user in the six hours before, in Spark's own join state.

    After the last part comes one row of each side that is a week later and has no number, so that the watermark passes all
    others and the rows without partner are given; these two, of no user that exists, are left out again.
    """
    events = t.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(time), F.max(time)).first()
    side = F.explode(F.array(*[F.struct(F.lit(n).cast("bigint").alias("user"), F.lit(kind).alias("kind")) for n, kind in ((-1, "purchase"), (-2, "view"))]))
    ends = events.agg(F.max("ts").alias("ts")).select("ts", side.alias("side")).select(
        F.lit(None).cast("bigint").alias("event_id"), F.col("side.user").alias("user_id"), F.col("side.kind").alias("event_type"),
        F.expr("ts + INTERVAL 7 DAYS").alias("ts"),
    )
    # parts by time, so that no row is late
    part = F.least(F.floor((time - F.lit(low)) * F.lit(t.PARTS) / F.lit(high - low + 1)), F.lit(t.PARTS)).cast("int")
    arrivals = t.Arrivals(spark, t.PARTS + 1, events=(events.unionByName(ends), part))

    def build(_checkpoint):
        def of(kind):
            rows = t.zoned(arrivals.stream("events"), "ts").where(F.col("event_type") == kind)
            return windows.with_watermark(
                rows.select("user_id", F.col("event_id").alias(f"{kind}_id"), F.col("ts").alias(f"{kind}_ts")), f"{kind}_ts", "0 seconds"
            )

        return joins.interval_join(of("purchase"), of("view"), ["user_id"], "purchase_ts", "view_ts", "-6 HOURS", "0 HOURS", how)

    rows = t.run_append(spark, arrivals, build).where("purchase_id IS NOT NULL OR view_id IS NOT NULL")
    return t.zoneless(rows, "purchase_ts", "view_ts")


@query(_interval_sql("INNER"))
def stream_interval_join(spark, sf_dir):
    return _purchases_and_views(spark, sf_dir, "inner")


@query(_interval_sql("LEFT"))
def stream_interval_join_left(spark, sf_dir):
    return _purchases_and_views(spark, sf_dir, "left")


@query(_interval_sql("RIGHT"))
def stream_interval_join_right(spark, sf_dir):
    return _purchases_and_views(spark, sf_dir, "right")


@query(_interval_sql("FULL"))
def stream_interval_join_full(spark, sf_dir):
    return _purchases_and_views(spark, sf_dir, "full")


def _customer_messages(spark, sf_dir, **others) -> t.Arrivals:
    """Change envelopes: creations first, then changes, then removals.

    A message takes far longer to write and to read than the row behind it, so the rows are dealt evenly before.
    """
    customers = t.table(spark, sf_dir, "customer").repartition(fair_partitions(spark), "c_custkey")
    messages_ = t.customer_changes(customers)
    return t.Arrivals(spark, t.PARTS, messages=(messages_, F.col("position")), **others)


def _changelog_sql(left: str, how: str) -> str:
    return f"""
    SELECT coalesce(l.stu_no, r.stu_no) AS stu_no, l.sub_no, l.score, r.stu_name, r.segment
    FROM ({left}) l {how} JOIN ({batch.NET_CUSTOMERS}) r ON l.stu_no = r.stu_no"""


_ORDERS_SQL = "SELECT o_custkey AS stu_no, o_orderkey AS sub_no, CAST(floor(o_totalprice) AS INTEGER) AS score FROM orders"
_EVENTS_SQL = "SELECT user_id AS stu_no, event_id AS sub_no, CAST(round(value * 100) AS INTEGER) AS score FROM events"


def _event_scores(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("stu_no"), F.col("event_id").alias("sub_no"), t.cents("value").alias("score")
    )


def _changes_of_join(spark, sf_dir, scores: DataFrame, how: str) -> DataFrame:
    """What the join wrote over all micro-batches: scores that wait for their student are padded, and taken back later."""
    arrivals = _customer_messages(spark, sf_dir, scores=(scores, t.by_content("sub_no")))

    def start(path, checkpoint):
        students = changelog.decode_changes(arrivals.stream("messages"), t.DIM_SCHEMA).select("_op", "stu_no", "stu_name", "segment")
        return delta_join.start_changelog_join(
            arrivals.stream("scores"), students, ["stu_no"], path, checkpoint, how, buckets=fair_partitions(spark)
        )

    return t.run_batches(spark, arrivals, start)


@query(_changelog_sql(_ORDERS_SQL, "LEFT"))
def stream_join_changelog(spark, sf_dir):
    changes = _changes_of_join(spark, sf_dir, t.ods_score(t.table(spark, sf_dir, "orders")), "left")
    return changelog.materialize(changes.drop("batch"))


@query(_changelog_sql(_EVENTS_SQL, "RIGHT"))
def stream_join_changelog_right(spark, sf_dir):
    changes = _changes_of_join(spark, sf_dir, _event_scores(t.table(spark, sf_dir, "events")), "right")
    return changelog.materialize(changes.drop("batch"))


@query(_changelog_sql(_EVENTS_SQL, "FULL"))
def stream_join_changelog_full(spark, sf_dir):
    changes = _changes_of_join(spark, sf_dir, _event_scores(t.table(spark, sf_dir, "events")), "full")
    return changelog.materialize(changes.drop("batch"))


def _forgetful_sql(how: str) -> str:
    return f"""
    SELECT coalesce(l.stu_no, r.stu_no) AS stu_no, l.sub_no, l.score, r.stu_name
    FROM (SELECT o_custkey AS stu_no, o_orderkey AS sub_no, CAST(floor(o_totalprice) AS INTEGER) AS score, o_orderkey % 3 AS part FROM orders) l
    {how} JOIN (
      SELECT c_custkey AS stu_no, c_name AS stu_name, c_custkey % 3 AS part,
        c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 1) AS met
      FROM customer
    ) r ON l.stu_no = r.stu_no AND (abs(l.part - r.part) <= 1 OR (l.part = 2 AND r.part = 0 AND r.met))"""


def _forgetful_changes(spark, sf_dir, how):
    """Three deliveries, one every 10 seconds by the stream's clock; rows that nobody meets are forgotten after 15.

    So a row of the first delivery meets one of the last only if a row of its key came on the other side in between.
    """
    scores, students = t.ods_score(t.table(spark, sf_dir, "orders")), t.dim_student(t.table(spark, sf_dir, "customer"))
    arrivals = t.Arrivals(
        spark, 3, scores=(scores, F.pmod("sub_no", F.lit(3))), students=(students, F.pmod("stu_no", F.lit(3)))
    )
    starts = itertools.count()

    def start(path, checkpoint):
        seconds = 10.0 * next(starts)
        return delta_join.start_changelog_join(
            arrivals.stream("scores"), arrivals.stream("students"), ["stu_no"], path, checkpoint, how, ttl_seconds=15.0,
            buckets=fair_partitions(spark), clock=lambda: seconds,
        )

    return changelog.materialize(t.run_batches(spark, arrivals, start).drop("batch"))


@query(_forgetful_sql("INNER"))
def stream_join_ttl(spark, sf_dir):
    return _forgetful_changes(spark, sf_dir, "inner")


@query(_forgetful_sql("LEFT"))
def stream_join_ttl_left(spark, sf_dir):
    return _forgetful_changes(spark, sf_dir, "left")


@query(_forgetful_sql("RIGHT"))
def stream_join_ttl_right(spark, sf_dir):
    return _forgetful_changes(spark, sf_dir, "right")


@query(_forgetful_sql("FULL"))
def stream_join_ttl_full(spark, sf_dir):
    return _forgetful_changes(spark, sf_dir, "full")


def _keyed_changes(spark, sf_dir, how):
    """The same with the rows in Spark's state store, for small and frequent micro-batches."""
    scores = _event_scores(t.table(spark, sf_dir, "events"))
    arrivals = _customer_messages(spark, sf_dir, scores=(scores, t.by_content("sub_no")))

    def build(checkpoint):
        seen = spark.read.schema("stu_no bigint").parquet(f"{arrivals.folder}/scores")
        hot = kept_with(spark, checkpoint, lambda: find_hot_keys(seen, ["stu_no"]))
        students = changelog.decode_changes(arrivals.stream("messages", t.KEYED_BATCH_BYTES), t.DIM_SCHEMA)
        return changelog_join.changelog_join(
            arrivals.stream("scores", t.KEYED_BATCH_BYTES), students.select("_op", "stu_no", "stu_name", "segment"), ["stu_no"], how, hot
        )

    return changelog.materialize(t.run_append(spark, arrivals, build))


@query(_changelog_sql(_EVENTS_SQL, "LEFT"))
def stream_join_changelog_keyed(spark, sf_dir):
    return _keyed_changes(spark, sf_dir, "left")


@query(_changelog_sql(_EVENTS_SQL, "RIGHT"))
def stream_join_changelog_keyed_right(spark, sf_dir):
    return _keyed_changes(spark, sf_dir, "right")


@query(_changelog_sql(_EVENTS_SQL, "FULL"))
def stream_join_changelog_keyed_full(spark, sf_dir):
    return _keyed_changes(spark, sf_dir, "full")


LOOKUP_SQL = "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _lookup(spark, sf_dir, start) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    arrivals = t.Arrivals(spark, t.PARTS, documents=(documents, t.by_content("doc_id")))
    return t.run_batches(spark, arrivals, lambda path, checkpoint: start(arrivals.stream("documents"), path, checkpoint)).drop("batch")


@query(LOOKUP_SQL)
def lookup_join(spark, sf_dir):
    def start(documents, path, checkpoint):
        return lookup.start_lookup(documents, lambda: t.table(spark, sf_dir, "labels"), ["doc_id"], path, checkpoint)

    return _lookup(spark, sf_dir, start)


@query(LOOKUP_SQL)
def lookup_join_cached(spark, sf_dir):
    def start(documents, path, checkpoint):
        return lookup.start_cached_lookup(
            documents, lambda: t.table(spark, sf_dir, "labels"), ["doc_id"], path, checkpoint, refresh_seconds=30
        )

    return _lookup(spark, sf_dir, start)


@query(batch.FIRST_ARRIVAL_SQL)
def first_arrival_join_stream(spark, sf_dir):
    arrivals = t.events_in_order(spark, sf_dir)

    def build(_checkpoint):
        clicks = batch.clicks_and_views(arrivals.stream("events", t.KEYED_BATCH_BYTES))[0]
        views = batch.clicks_and_views(arrivals.stream("events", t.KEYED_BATCH_BYTES))[1]
        return keyed.first_arrival_join(clicks, views, "user_id", "event_id")

    return t.run_append(spark, arrivals, build)


@query(batch.FIRST_ARRIVAL_SQL)
def first_arrival_join_large_batches(spark, sf_dir):
    arrivals = t.events_in_order(spark, sf_dir)

    def start(path, checkpoint):
        clicks = batch.clicks_and_views(arrivals.stream("events"))[0]
        views = batch.clicks_and_views(arrivals.stream("events"))[1]
        return carried.start_first_arrival_join(clicks, views, "user_id", "event_id", path, checkpoint, buckets=fair_partitions(spark))

    return t.run_batches(spark, arrivals, start).drop("batch")
