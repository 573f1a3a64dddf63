"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Settings that change results, or that the plans here are built on; everything else is left to
# the cluster's own configuration.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A value that does not fit its column raises instead of becoming null.
    "spark.sql.ansi.enabled": "true",
    # HotSpot never compiles a method of more than 8000 bytecodes. The contract rules generate
    # such a method; with this limit Spark emits them as several small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the engine settings to ``spark`` and return it."""
    for key, value in ENGINE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC dates; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams.

    The number of state partitions is fixed at a query's first start, for as long as its checkpoint
    lives. It is the caller's choice, or the configured ``spark.sql.shuffle.partitions``; the cores that
    happen to be there when a stream starts play no part. State lives in RocksDB (on executor disk, with
    changelogs in the checkpoint) rather than on the heap.
    """
    session = tune(spark.newSession())
    partitions = state_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return session


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under the folder that all executors share (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidemart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def together(jobs: list[Callable[[], Result]]) -> list[Result]:
    """The results of independent jobs that are submitted at the same time, so that small stages of one
    fill the cores that another leaves idle. All end before the first failure is raised."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        futures = [pool.submit(job) for job in jobs]
    return [future.result() for future in futures]
