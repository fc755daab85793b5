"""The given tables and the inputs that the queries derive from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scoped_conf, shared_folder
from millrace.sources.changelog import encode_change
from millrace.streaming import runner


# Declared schemas of the given tables: nothing is inferred, so no job runs before the query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Input of one micro-batch for operators whose Python state processors hold the changes of a key in memory.
KEYED_BATCH_BYTES = 256 << 20


class Arrivals:
    """Tables that arrive part by part, as the input of streams.

    Each table is cut by a column expression that gives the number of a row's part. ``deliver`` puts the rows of one part
    into the folders that the streams read; a query is started after each delivery and resumes from its checkpoint, so
    every part is a micro-batch of its own and every run but the first a restart.
    """

    def __init__(self, spark: SparkSession, parts: int, **tables: tuple[DataFrame, Column]):
        self.spark, self.parts, self.tables = spark, parts, tables
        self.folder = shared_folder(spark, "arrivals")

    def deliver(self, part: int) -> None:
        for name, (df, number) in self.tables.items():
            df.where(number == part).write.mode("append").parquet(f"{self.folder}/{name}")

    def stream(self, name: str, max_bytes: int | None = None) -> DataFrame:
        """``max_bytes`` limits a micro-batch; without it one takes all new files."""
        reader = self.spark.readStream.schema(self.tables[name][0].schema)
        if max_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", str(max_bytes))
        return reader.parquet(f"{self.folder}/{name}")


PARTS = 3


def by_content(*columns: str) -> Column:
    """Parts of about equal size, whatever the order of the rows."""
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS)).cast("int")


def by_order(df: DataFrame, column: str) -> Column:
    """Parts that follow each other in ``column``."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return F.floor((F.col(column) - F.lit(low)) * F.lit(PARTS) / F.lit((high or 0) - (low or 0) + 1)).cast("int")


# Rows that come when their windows are long closed: every fiftieth of the first half of the time.
LATE_SQL = "(event_id % 50 = 0 AND epoch_us(ts) < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events))"


def events_in_time(spark: SparkSession, sf_dir: str) -> Arrivals:
    """Events in parts that follow each other in time, and in a last part the late ones (``LATE_SQL``)."""
    events = table(spark, sf_dir, "events")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(time), F.max(time)).first()
    part = F.floor((time - F.lit(low)) * F.lit(PARTS) / F.lit(high - low + 1)).cast("int")
    late = (F.col("event_id") % 50 == 0) & (time < F.lit((low + high) // 2))
    return Arrivals(spark, PARTS + 1, events=(events, F.when(late, F.lit(PARTS)).otherwise(part)))


def events_in_order(spark: SparkSession, sf_dir: str) -> Arrivals:
    """Events in parts that follow each other by their numbers."""
    events = table(spark, sf_dir, "events")
    return Arrivals(spark, PARTS, events=(events, by_order(events, "event_id")))


def events_by_content(spark: SparkSession, sf_dir: str) -> Arrivals:
    return Arrivals(spark, PARTS, events=(table(spark, sf_dir, "events"), by_content("event_id")))


def zoned(df: DataFrame, *names: str) -> DataFrame:
    """Times with a zone, as watermarks need them."""
    for name in names:
        df = df.withColumn(name, F.col(name).cast("timestamp"))
    return df


def zoneless(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


def cents(column: str):
    return F.round(F.col(column) * 100).cast("int")


def income(events: DataFrame) -> DataFrame:
    """(amount, ts) plus the event's number."""
    return events.select("event_id", "ts", cents("value").alias("amount"))


def score(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("stuname"),
        F.col("event_type").alias("subject"),
        cents("value").alias("score"),
        "ts",
        "event_id",
    )


def accounting(events: DataFrame) -> DataFrame:
    """(uid, income, expense): purchases and sign-ups earn, errors cost, other events have neither."""
    return events.select(
        F.col("user_id").cast("int").alias("uid"),
        F.when(F.col("event_type").isin("purchase", "signup"), cents("value")).alias("income"),
        F.when(F.col("event_type") == "error", cents("value")).alias("expense"),
        "event_id",
    )


def ods_score(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("stu_no"),
        F.col("o_orderkey").alias("sub_no"),
        F.floor("o_totalprice").cast("int").alias("score"),
    )


def dim_student(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("stu_no"), F.col("c_name").alias("stu_name"))


DIM_SCHEMA = "stu_no bigint, stu_name string, segment string, balance bigint"


def customer_changes(customer: DataFrame) -> DataFrame:
    """Change envelopes for every customer, as JSON text with their position.

    Each customer is created; one in debt is renamed; one in the machinery segment is removed in the end.
    """

    def image(name):
        return F.struct(
            F.col("c_custkey").alias("stu_no"),
            name.alias("stu_name"),
            F.col("c_mktsegment").alias("segment"),
            F.round(F.col("c_acctbal") * 100).cast("long").alias("balance"),
        )

    old = image(F.col("c_name"))
    new = image(F.concat("c_name", F.lit("-v2")))
    in_debt, leaves = F.col("c_acctbal") < 0, F.col("c_mktsegment") == "MACHINERY"

    def message(position: int, text):
        return F.struct(F.lit(position).alias("position"), text.alias("value"))

    messages = F.array(
        message(0, encode_change(F.lit("c"), None, old)),
        F.when(in_debt, message(1, encode_change(F.lit("u"), old, new))),
        F.when(leaves & in_debt, message(2, encode_change(F.lit("d"), new, None)))
        .when(leaves, message(2, encode_change(F.lit("d"), old, None))),
    )
    return customer.select(F.col("c_custkey").alias("source_key"), F.explode(F.array_compact(messages)).alias("_m")).select(
        "source_key", "_m.*"
    )


def _state_conf(spark: SparkSession):
    """One state store per core at most; the number belongs to the checkpoint."""
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return scoped_conf(spark, spark__sql__shuffle__partitions=max(1, partitions))


def run_append(spark: SparkSession, arrivals: Arrivals, build: Callable[[str], DataFrame]) -> DataFrame:
    """Run a stream in append mode after each delivery and give what it wrote; ``build`` gets the checkpoint's path."""
    with _state_conf(spark):
        folder = shared_folder(spark, "stream")
        for part in range(arrivals.parts):
            arrivals.deliver(part)
            stream = build(f"{folder}/checkpoint")
            runner.finish(runner.start_append(stream, f"{folder}/rows", f"{folder}/checkpoint"))
        return runner.read_append(spark, f"{folder}/rows", stream)


def run_batches(spark: SparkSession, arrivals: Arrivals, start: Callable[[str, str], object]) -> DataFrame:
    """Run a stream that writes numbered micro-batches after each delivery; the result has the number in ``batch``."""
    with _state_conf(spark):
        folder = shared_folder(spark, "stream")
        for part in range(arrivals.parts):
            arrivals.deliver(part)
            runner.finish(start(f"{folder}/rows", f"{folder}/checkpoint"))
        return runner.read_batches(spark, f"{folder}/rows")
