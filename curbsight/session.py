"""Session settings and shared scratch space."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Everything else is left to the cluster's own defaults.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Recording the Python call site of every column costs more than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Keeps streaming state off the heap, so it can grow with the number of open keys.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = 8, app: str = "curbsight", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**JOB_CONF, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@functools.cache
def _local_base(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"curbsight-{application_id}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_base(spark.sparkContext.applicationId)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until it is written to."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
