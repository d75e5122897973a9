"""Session helpers: a local session for tests / bench and the shared scratch root."""

from __future__ import annotations

import contextlib
import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, event_log_dir: str | None = None
) -> SparkSession:
    """A ``local[cores]`` session with AQE on and the UI off (tests, bench).

    ``event_log_dir`` turns on Spark's event log there (stage and task times
    for ``tools/stage_times.py``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cargoline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local data is small: aim AQE at ~8 MB partitions and let it go down
        # to 256 KB so eight cores stay busy, e.g. several tasks share the
        # date folders of a partitioned write (clusters keep their own sizes).
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        # A listing job pays off for many folders on a remote store; on a
        # local disk the driver lists hundreds of date folders in ~0.2 s
        # where a listing job costs ~2 s.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "10000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARGOLINE_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", event_log_dir
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none (a bare test session) gets a
    folder made here and registered as its checkpoint dir; on a cluster a
    machine-local folder would be invisible to executors, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors "
                "(e.g. on HDFS or an object store)"
            )
        root = tempfile.mkdtemp(prefix="cargoline-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def bytes_of(spark: SparkSession, key: str) -> int:
    """A setting of a number of bytes, written as ``64MB`` or the like."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


@contextlib.contextmanager
def settings(spark: SparkSession, changed: dict[str, int]) -> Iterator[None]:
    """What is planned inside goes by the ``changed`` settings; afterwards the session's own hold."""
    own = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in own.items():
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared root.

    Grouped by UTC day (``cargoline/scratch/<yyyyMMdd>/``) so a retention
    policy on the shared folder can drop whole days of query outputs.
    """
    day = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d")
    return f"{shared_root(spark)}/cargoline/scratch/{day}/{name}-{uuid.uuid4().hex}"
