"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_SETTINGS = {
    # bad numbers and a zero divisor fail the query instead of giving NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # runtime join choice and splitting of skewed partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Arrow batches of long texts stay small
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    # equality filters reach Python data sources
    "spark.sql.python.filterPushdown.enabled": "true",
    # state on disk, with only the changes uploaded at each commit
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package()
    return spark


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the engine's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package()
    return spark


def ship_package() -> None:
    """Let Spark send this package's classes to the Python workers by value, so that none has to be installed there."""
    import millrace

    cloudpickle.register_pickle_by_value(millrace)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder named in ``spark.checkpoint.dir``.

    All executors must see the folder, so a machine-local one is used only when Spark itself is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def fair_partitions(spark: SparkSession) -> int:
    """Number of parts into which a hot key is split: one per shuffle partition."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class scoped_conf:
    """Set session options for the length of a ``with`` block."""

    def __init__(self, spark: SparkSession, **conf: str):
        self.spark = spark
        self.conf = {key.replace("__", "."): str(value) for key, value in conf.items()}
        self.before: dict[str, str | None] = {}

    def __enter__(self) -> SparkSession:
        for key, value in self.conf.items():
            self.before[key] = self.spark.conf.get(key, None)
            self.spark.conf.set(key, value)
        return self.spark

    def __exit__(self, *exc) -> None:
        for key, value in self.before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)
