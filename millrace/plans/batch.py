"""Queries on bounded tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import aggregate, lifecycle, registry, scalar
from millrace.operators import aggregates, joins, lateral, ordering, projection, running, windows
from millrace.operators.salting import Salting
from millrace.plans import tables as t
from millrace.session import shared_folder
from millrace.sinks import tables as sink_tables
from millrace.sources import changelog, delimited, logtail

Query = Callable[[SparkSession, str], DataFrame]
BATCH: dict[str, tuple[Query, str]] = {}


def query(sql: str):
    """Register a query under its function's name together with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        BATCH[function.__name__] = (function, sql)
        return function

    return add


# ---- scans and sinks

LOG_SCHEMA = "l_orderkey bigint, l_linenumber int, quantity int, l_returnflag string, l_partkey int"


def log_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws(
            ",", "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int"), "l_returnflag", F.col("l_partkey")
        ).alias("value")
    )


def lineitem_log(spark: SparkSession, sf_dir: str) -> str:
    """The line items as delimited text in the shared folder."""
    path = shared_folder(spark, "log")
    log_lines(t.table(spark, sf_dir, "lineitem")).write.text(path)
    return path


@query("SELECT o_custkey AS stu_no, o_orderkey AS sub_no, CAST(floor(o_totalprice) AS INTEGER) AS score FROM orders")
def project_scan(spark, sf_dir):
    return projection.project(t.ods_score(t.table(spark, sf_dir, "orders")), "stu_no", "sub_no", "score")


@query(
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders "
    "WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'"
)
def filter_conjunction(spark, sf_dir):
    orders = projection.keep(t.table(spark, sf_dir, "orders"), "o_orderstatus = 'O'", "o_orderpriority <> '5-LOW'")
    return projection.project(orders, "o_orderkey", "o_custkey", "o_orderpriority")


@query("SELECT event_id, user_id, true AS stamped FROM events")
def processing_time_column(spark, sf_dir):
    events = windows.with_processing_time(t.table(spark, sf_dir, "events"), "pt")
    return events.select("event_id", "user_id", (F.col("pt") > F.col("ts").cast("timestamp")).alias("stamped"))


@query(
    "SELECT o_custkey AS stu_no, CAST(NULL AS VARCHAR) AS stu_name, o_orderkey AS sub_no, "
    "CAST(floor(o_totalprice) AS INTEGER) AS score FROM orders"
)
def insert_select(spark, sf_dir):
    sink = {"stu_no": "bigint", "stu_name": "string", "sub_no": "bigint", "score": "int"}
    return projection.insert_columns(t.ods_score(t.table(spark, sf_dir, "orders")), sink, ["stu_no", "sub_no", "score"])


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity, l_returnflag, CAST(l_partkey AS INTEGER) AS l_partkey "
    "FROM lineitem WHERE l_linenumber <> 1 AND l_returnflag = 'R'"
)
def log_scan_filter(spark, sf_dir):
    log = delimited.scan_log(spark, lineitem_log(spark, sf_dir), LOG_SCHEMA)
    return projection.keep(log, "l_linenumber <> 1", "l_returnflag = 'R'")


@query(
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity, l_returnflag, CAST(l_partkey AS INTEGER) AS l_partkey "
    "FROM lineitem WHERE l_linenumber = 1 AND l_returnflag = 'A' AND l_quantity <> 5"
)
def log_scan_pushdown(spark, sf_dir):
    log = logtail.read_log(spark, lineitem_log(spark, sf_dir), LOG_SCHEMA)
    return projection.keep(log, "l_linenumber = 1", "l_returnflag = 'A'", "quantity <> 5")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_decode(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    record = F.from_json("props", "k int", {"mode": "FAILFAST"})
    return events.select("event_id", record.alias("_r")).select("event_id", "_r.k")


@query(
    """
    WITH target AS (
      SELECT user_id AS uid, CAST(ts AS DATE) AS day, max(CAST(round(value * 100) AS INTEGER)) AS amount, 'signup' AS kind
      FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
    updates AS (
      SELECT user_id AS uid, CAST(ts AS DATE) AS day,
             arg_max(CAST(round(value * 100) AS INTEGER), event_id) AS amount, 'purchase' AS kind
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT * FROM updates
    UNION ALL
    SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.uid = t.uid AND u.day = t.day)
    """
)
def upsert_keyed(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("uid"), F.to_date("ts").alias("day"), t.cents("value").alias("amount"),
        F.col("event_type").alias("kind"), "event_id",
    )
    target = events.where("kind = 'signup'").groupBy("uid", "day").agg(F.max("amount").alias("amount"), F.lit("signup").alias("kind"))
    return sink_tables.upsert(target, events.where("kind = 'purchase'"), ["uid", "day"], ["event_id"])


# ---- change data

NET_CUSTOMERS = """
    SELECT c_custkey AS stu_no, CASE WHEN c_acctbal < 0 THEN c_name || '-v2' ELSE c_name END AS stu_name,
           c_mktsegment AS segment, CAST(round(c_acctbal * 100) AS BIGINT) AS balance
    FROM customer WHERE c_mktsegment <> 'MACHINERY'"""


def _changes(spark, sf_dir, carry=()):
    envelopes = t.customer_changes(t.table(spark, sf_dir, "customer"))
    return changelog.decode_changes(envelopes, t.DIM_SCHEMA, carry=carry)


@query(NET_CUSTOMERS)
def changelog_net(spark, sf_dir):
    return changelog.materialize(_changes(spark, sf_dir), ignore=["_part"])


@query(NET_CUSTOMERS)
def changelog_latest(spark, sf_dir):
    changes = _changes(spark, sf_dir, ["position"])
    return changelog.latest_by_key(changes, ["stu_no"], ["position", "_part"])


@query(
    f"SELECT segment, CAST(sum(balance) AS BIGINT) AS balance, CAST(count(*) AS BIGINT) AS students FROM ({NET_CUSTOMERS}) GROUP BY segment"
)
def retracted_sum(spark, sf_dir):
    return aggregates.retractable(_changes(spark, sf_dir), ["segment"], balance="balance", students=F.lit(1).cast("long"))


# ---- joins

@query(
    "SELECT o_custkey AS stu_no, c_name AS stu_name, o_orderkey AS sub_no, CAST(floor(o_totalprice) AS INTEGER) AS score "
    "FROM orders JOIN customer ON o_custkey = c_custkey"
)
def join_inner(spark, sf_dir):
    scores, students = t.ods_score(t.table(spark, sf_dir, "orders")), t.dim_student(t.table(spark, sf_dir, "customer"))
    return joins.regular_join(scores, students, ["stu_no"]).select("stu_no", "stu_name", "sub_no", "score")


@query(
    """
    SELECT c_name AS stuname, o_orderpriority AS subject, CAST(floor(o_totalprice) AS INTEGER) AS score,
           c_mktsegment AS class, c_nationkey AS gender, CAST(floor(c_acctbal) AS INTEGER) AS age, n_name AS city
    FROM (SELECT *, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS stuname FROM orders)
    JOIN customer ON stuname = c_name JOIN nation ON c_nationkey = n_nationkey
    """
)
def join_inner_text_key(spark, sf_dir):
    scores = t.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("stuname"),
        F.col("o_orderpriority").alias("subject"), F.floor("o_totalprice").cast("int").alias("score"),
    )
    nation = t.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("gender"), F.col("n_name").alias("city"))
    students = t.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("stuname"), F.col("c_mktsegment").alias("class"), F.col("c_nationkey").alias("gender"),
        F.floor("c_acctbal").cast("int").alias("age"),
    )
    students = joins.regular_join(students, nation, ["gender"])
    joined = joins.regular_join(scores, students, ["stuname"])
    return joined.select("stuname", "subject", "score", "class", "gender", "age", "city")


def _order_lines(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"), "o_custkey", "o_orderpriority"
    )
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("status"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    return lines, orders


def _order_lines_sql(how: str) -> str:
    return f"""
    SELECT coalesce(l_orderkey, o_orderkey) AS orderkey, coalesce(l_linestatus, o_orderstatus) AS status,
           l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderpriority
    FROM lineitem {how} JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus"""


@query(_order_lines_sql("LEFT"))
def join_left(spark, sf_dir):
    lines, orders = _order_lines(spark, sf_dir)
    return joins.regular_join(lines, orders, ["orderkey", "status"], "left")


@query(_order_lines_sql("RIGHT"))
def join_right(spark, sf_dir):
    lines, orders = _order_lines(spark, sf_dir)
    return joins.regular_join(lines, orders, ["orderkey", "status"], "right")


@query(_order_lines_sql("FULL"))
def join_full(spark, sf_dir):
    lines, orders = _order_lines(spark, sf_dir)
    return joins.regular_join(lines, orders, ["orderkey", "status"], "full")


@query(_order_lines_sql("FULL"))
def join_full_salted(spark, sf_dir):
    lines, orders = _order_lines(spark, sf_dir)
    return joins.regular_join(lines, orders, ["orderkey", "status"], "full", salting=Salting(4))


@query(
    """
    SELECT l_orderkey AS orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY
    """
)
def join_equal_and_theta(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 60 days")
    return joins.regular_join(lines, orders, ["orderkey"], "left", late)


def _views_and_purchases(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    views = events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"))
    purchases = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer")
    )
    return purchases, views


def _theta_sql(how: str) -> str:
    return f"""
    SELECT purchase_id, buyer, view_id, viewer
    FROM (SELECT event_id AS purchase_id, user_id AS buyer FROM events WHERE event_type = 'purchase')
    {how} JOIN (SELECT event_id AS view_id, user_id AS viewer FROM events WHERE event_type = 'view')
    ON view_id BETWEEN purchase_id - 5 AND purchase_id - 1 AND viewer <> buyer"""


def _theta(spark, sf_dir, how):
    purchases, views = _views_and_purchases(t.table(spark, sf_dir, "events"))
    return joins.band_join(purchases, views, "purchase_id", "view_id", -5, -1, how, condition=F.col("viewer") != F.col("buyer"))


@query(_theta_sql("INNER"))
def join_theta(spark, sf_dir):
    return _theta(spark, sf_dir, "inner")


@query(_theta_sql("LEFT"))
def join_theta_left(spark, sf_dir):
    return _theta(spark, sf_dir, "left")


@query(_theta_sql("RIGHT"))
def join_theta_right(spark, sf_dir):
    return _theta(spark, sf_dir, "right")


@query(_theta_sql("FULL"))
def join_theta_full(spark, sf_dir):
    return _theta(spark, sf_dir, "full")


@query(
    """
    SELECT o_orderkey, o_custkey, last_flag FROM orders LEFT JOIN (
      SELECT l_orderkey, arg_max(l_returnflag, (l_shipdate, l_linenumber, l_returnflag)) AS last_flag FROM lineitem GROUP BY 1
    ) ON o_orderkey = l_orderkey
    """
)
def enrich_lookup(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("last_flag"), "l_shipdate", "l_linenumber"
    )
    return joins.enrich(orders, dim, "o_orderkey", ["l_shipdate", "l_linenumber", "last_flag"], ["last_flag"])


LATERAL_SQL = """
    SELECT e.uid, d.income, d.expense FROM (SELECT CAST(user_id AS INTEGER) AS uid FROM events) e
    LEFT JOIN (VALUES (1, 100, 20), (1, 200, 50), (2, 50, NULL), (3, NULL, 100)) AS d(record_uid, income, expense)
    ON e.uid = d.record_uid"""


@query(LATERAL_SQL)
def lateral_table_function(spark, sf_dir):
    registry.register_all(spark)
    users = t.table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("uid"))
    return lateral.lateral_left_join(users, "get_detail", ["uid"], ["income", "expense"])


@query(LATERAL_SQL)
def lateral_python_function(spark, sf_dir):
    registry.register_all(spark)
    users = t.table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("uid"))
    return lateral.lateral_left_join(users, "get_detail_py", ["uid"], ["income", "expense"])


FIRST_ARRIVAL_SQL = """
    WITH u AS (
      SELECT user_id, event_id, CASE event_type WHEN 'click' THEN 'l' ELSE 'r' END AS side,
             CAST(round(value * 100) AS INTEGER) AS v
      FROM events WHERE event_type IN ('click', 'view')),
    f AS (SELECT *, first_value(side) OVER w AS fs FROM u WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    b AS (SELECT *, last_value(CASE WHEN side = fs THEN v END IGNORE NULLS) OVER w AS buf FROM f
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT user_id, event_id, CASE WHEN side = 'l' THEN v ELSE buf END AS click_amount,
           CASE WHEN side = 'r' THEN v ELSE buf END AS view_amount
    FROM b WHERE side <> fs"""


def clicks_and_views(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    def of(kind: str) -> DataFrame:
        return events.where(F.col("event_type") == kind).select("user_id", "event_id", t.cents("value").alias(f"{kind}_amount"))

    return of("click"), of("view")


@query(FIRST_ARRIVAL_SQL)
def first_arrival_join(spark, sf_dir):
    return running.first_arrival_join(*clicks_and_views(t.table(spark, sf_dir, "events")), "user_id", "event_id")


# ---- aggregates and functions

GROUP_SUM_SQL = (
    "SELECT CAST(user_id AS VARCHAR) AS stuname, CAST(sum(CAST(round(value * 100) AS INTEGER)) AS BIGINT) AS total_score "
    "FROM events GROUP BY 1"
)


@query(GROUP_SUM_SQL)
def group_sum(spark, sf_dir):
    return aggregates.group_sum(t.score(t.table(spark, sf_dir, "events")), ["stuname"], "score", "total_score")


ACCOUNTING_SQL = """
    (SELECT CAST(user_id AS INTEGER) AS uid, event_id,
            CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(round(value * 100) AS INTEGER) END AS income,
            CASE WHEN event_type = 'error' THEN CAST(round(value * 100) AS INTEGER) END AS expense
     FROM events)"""

BALANCE_SQL = f"""
    SELECT uid, CAST(sum(coalesce(income, 0)) - sum(coalesce(expense, 0)) AS BIGINT) AS total_balance
    FROM {ACCOUNTING_SQL} GROUP BY uid"""


@query(f"SELECT event_id, uid, coalesce(income, 0) - coalesce(expense, 0) AS balance FROM {ACCOUNTING_SQL}")
def scalar_function(spark, sf_dir):
    registry.register_all(spark)
    rows = t.accounting(t.table(spark, sf_dir, "events"))
    return rows.selectExpr("event_id", "uid", "calc_bal(income, expense) AS balance")


@query(BALANCE_SQL)
def aggregate_balance(spark, sf_dir):
    rows = t.accounting(t.table(spark, sf_dir, "events"))
    return aggregates.group_aggregate(rows, ["uid"], aggregate.calc_total_bal("income", "expense").alias("total_balance"))


@query(BALANCE_SQL)
def aggregate_own_function(spark, sf_dir):
    rows = t.accounting(t.table(spark, sf_dir, "events"))
    return aggregate.apply_aggregate(rows, ["uid"], aggregate.TotalBalance(), ["income", "expense"], "total_balance")


@query("""
SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 9007199254740992 + o_custkey END AS account,
  CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN 9007199254740993 + o_orderkey ELSE 0 END) - sum(o_orderkey) AS BIGINT) AS total_balance
FROM orders GROUP BY 1
""")
def aggregate_own_function_large_keys(spark, sf_dir):
    """Keys and values beyond 2^53, with NULLs beside them."""
    orders = t.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, F.lit(2**53) + F.col("o_custkey")).alias("account"),
        F.when(F.col("o_orderstatus") != "F", F.lit(2**53 + 1) + F.col("o_orderkey")).alias("income"),
        F.col("o_orderkey").alias("expense"),
    )
    return aggregate.apply_aggregate(orders, ["account"], aggregate.TotalBalance(), ["income", "expense"], "total_balance")


@query("SELECT l_orderkey AS stu_no, CAST(sum(10 // l_linenumber) AS BIGINT) AS num FROM lineitem GROUP BY 1")
def aggregate_of_scalar(spark, sf_dir):
    registry.register_all(spark)
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("stu_no")).agg(F.expr("sum(func1(l_linenumber))").alias("num"))


@query(
    "SELECT l_orderkey, l_partkey, l_linenumber, CAST(abs(10 // (10 - l_linenumber)) AS BIGINT) AS result FROM lineitem"
)
def map_chain(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").withColumn("value", F.col("l_linenumber").cast("string"))
    return lines.select("l_orderkey", "l_partkey", "l_linenumber", scalar.distance_quotient("value").alias("result"))


RUNNING_SQL = """
    SELECT user_id, event_id, CAST(sum(CAST(round(value * 100) AS INTEGER))
           OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total
    FROM events"""


@query(RUNNING_SQL)
def running_total(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select("user_id", "event_id", t.cents("value").alias("amount"))
    return running.running_total(events, ["user_id"], "event_id", "amount").drop("amount")


# ---- windows and order

TUMBLE_SQL = """
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, CAST(sum(amount) AS BIGINT) AS total_amount
    FROM (SELECT date_trunc('hour', ts) AS window_start, CAST(round(value * 100) AS INTEGER) AS amount FROM events)
    GROUP BY 1"""

HOP_SQL = """
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, CAST(sum(amount) AS BIGINT) AS total_amount
    FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(10 * k) AS window_start,
                 CAST(round(value * 100) AS INTEGER) AS amount
          FROM events, (SELECT unnest(generate_series(0, 5)) AS k))
    GROUP BY 1"""

CUMULATE_SQL = """
    SELECT window_start, window_start + to_hours(k) AS window_end, CAST(sum(amount) AS BIGINT) AS total_amount
    FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, hour(ts) AS h,
                 CAST(round(value * 100) AS INTEGER) AS amount FROM events)
    JOIN (SELECT unnest(generate_series(1, 24)) AS k) ON k > h
    GROUP BY window_start, k"""


def total():
    return [F.sum("amount").alias("total_amount")]


@query(TUMBLE_SQL)
def tumble(spark, sf_dir):
    return windows.tumble(t.income(t.table(spark, sf_dir, "events")), "ts", "1 hour", total())


@query(
    "SELECT event_id, ts, CAST(round(value * 100) AS INTEGER) AS amount, date_trunc('hour', ts) AS window_start, "
    "date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "date_trunc('hour', ts) + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND AS window_time FROM events"
)
def tumble_rows(spark, sf_dir):
    return windows.tumble_rows(t.income(t.table(spark, sf_dir, "events")), "ts", "1 hour")


@query(HOP_SQL)
def hop(spark, sf_dir):
    return windows.hop(t.income(t.table(spark, sf_dir, "events")), "ts", "10 minutes", "1 hour", {"total_amount": ("sum", "amount")})


@query(CUMULATE_SQL)
def cumulate(spark, sf_dir):
    rows = t.income(t.table(spark, sf_dir, "events"))
    return windows.cumulate(rows, "ts", "1 hour", "1 day", {"total_amount": ("sum", "amount")})


@query("SELECT CAST(sum(CAST(round(value * 100) AS INTEGER)) AS BIGINT) AS total_amount FROM events")
def processing_time_tumble(spark, sf_dir):
    by_window = windows.tumble_by_processing_time(t.income(t.table(spark, sf_dir, "events")), "1 minute", total())
    return by_window.agg(F.sum("total_amount").alias("total_amount"))


@query("SELECT CAST(user_id AS VARCHAR) AS stuname, event_type AS subject, CAST(round(value * 100) AS INTEGER) AS score, ts FROM events")
def order_by_time(spark, sf_dir):
    return ordering.order_by_time(t.score(t.table(spark, sf_dir, "events")), "ts", "event_id").drop("event_id")


@query(
    """
    SELECT date_trunc('day', ts + INTERVAL 8 HOUR)::TIMESTAMP AS local_start,
           date_trunc('day', ts + INTERVAL 8 HOUR)::TIMESTAMP + INTERVAL 1 DAY AS local_end,
           CAST(sum(CAST(round(value * 100) AS INTEGER)) AS BIGINT) AS total_amount
    FROM events GROUP BY 1, 2
    """
)
def session_zone_day(spark, sf_dir):
    """Day windows that begin at local midnight, shown in local time."""
    rows = t.zoned(t.income(t.table(spark, sf_dir, "events")), "ts")
    days = windows.tumble(rows, "ts", "1 day", total(), offset=windows.day_offset("Asia/Shanghai", (2024, 2024)))
    start, end = (windows.local_time(column, "Asia/Shanghai") for column in ("window_start", "window_end"))
    return days.select(start.alias("local_start"), end.alias("local_end"), "total_amount")


@query("SELECT event_id, ts + INTERVAL 8 HOUR AS local_ts FROM events")
def session_zone_rows(spark, sf_dir):
    """Instants shown in local time."""
    rows = t.zoned(t.table(spark, sf_dir, "events"), "ts")
    return rows.select("event_id", windows.local_time("ts", "Asia/Shanghai").alias("local_ts"))


@query(
    "SELECT user_id, ts, CAST(sum(CAST(round(value * 100) AS INTEGER)) "
    "OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total FROM events"
)
def running_total_by_time(spark, sf_dir):
    events = t.table(spark, sf_dir, "events").select("user_id", "ts", t.cents("value").alias("amount"))
    return running.running_total(events, ["user_id"], "ts", "amount").drop("amount")


@query("""
WITH calls AS (
  SELECT o_orderkey, o_orderdate + to_minutes(o_orderkey % 1440) AS ts, year(o_orderdate) AS y FROM orders
), turns AS (
  SELECT *, make_date(y, 4, 1) + CAST((7 - dayofweek(make_date(y, 4, 1))) % 7 AS INTEGER) + INTERVAL 7 HOUR AS spring,
    make_date(y, 10, 31) - CAST(dayofweek(make_date(y, 10, 31)) AS INTEGER) + INTERVAL 6 HOUR AS autumn
  FROM calls
)
SELECT CAST(ts - CASE WHEN ts >= spring AND ts < autumn THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS DATE) AS local_day,
  count(*) AS calls
FROM turns GROUP BY 1
""")
def tumble_local_days(spark, sf_dir):
    """Days in a zone with summer time (first Sunday of April to last Sunday of October in these years)."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("o_orderkey") % 1440).cast("int"))
    calls = t.zoned(t.table(spark, sf_dir, "orders").select((F.col("o_orderdate") + minutes).alias("ts")), "ts")
    return windows.tumble_local_days(calls, "ts", "America/New_York", [F.count(F.lit(1)).alias("calls")])


@query("""
SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(round(l_extendedprice, 1) AS DECIMAL(12, 1)) AS price,
  CAST(l_shipdate AS DATE) AS shipped, l_shipdate + to_seconds(l_linenumber) AS shipped_at, l_returnflag
FROM lineitem
""")
def log_scan_typed(spark, sf_dir):
    """A log with every kind of field: whole numbers, decimals that are rounded, days, times and text."""
    rows = t.table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            ";", "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(14,2)"), F.datediff("l_shipdate", F.lit("1970-01-01")),
            F.date_format(F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("l_linenumber").cast("decimal(18,6)")), "yyyy-MM-dd HH:mm:ss"), "l_returnflag",
        ).alias("value")
    )
    path = shared_folder(spark, "log")
    rows.write.text(path)
    schema = "l_orderkey bigint, l_linenumber smallint, price decimal(12,1), shipped date, shipped_at timestamp_ntz, l_returnflag string"
    return delimited.scan_log(spark, path, schema, ";")


@query("SELECT user_id, event_id, CAST(round(value * 100) AS INTEGER) * 3 AS amount FROM events")
def function_with_resource(spark, sf_dir):
    """A function that opens something once per task; here a factor that it looks up when it is opened."""
    rows = t.table(spark, sf_dir, "events").select("user_id", "event_id", t.cents("value").alias("amount"))

    def call(factors, batch):
        return batch.assign(amount=batch["amount"] * factors["amount"])

    return lifecycle.map_with_resource(
        rows, lambda: {"amount": 3}, call, "user_id bigint, event_id bigint, amount int", lambda factors: factors.clear()
    )
