"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

#: A side of a join is broadcast only when its size estimate is below this; the same as Spark's own default.
BROADCAST_BYTES = 10 * 1024 * 1024


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfstar")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder of the session; make one up only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="shelfstar-checkpoint-")
    context.setCheckpointDir(shared)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for what begins in this block."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def shuffles_released(spark: SparkSession) -> AbstractContextManager[None]:
    """What a query in this block has shuffled leaves the disks when the query ends, and not when the driver next collects its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


#: Of the off-heap memory that the state of all streams may take in an executor.
STATE_MB = 256
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MB),
}


def ensure_disk_state(spark: SparkSession) -> None:
    """Keep the state of streams on the executors' disks, with a bounded cache, unless the session chose a store itself. On the heap, which is
    Spark's default, state that grows with the events within the delay leaves no memory for anything else. A stream that goes on
    from a checkpoint keeps the store it began with."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") == "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider":
        for setting, value in _STATE.items():
            spark.conf.set(setting, value)


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of a plan; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def broadcast_threshold(spark: SparkSession) -> int:
    """Below this estimate Spark itself broadcasts a side of a join."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
