"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

# Runtime settings every job of this library expects; all of them may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE split a hot join partition even where an aggregate on the same key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Plans that are kept for several uses get partitions of a sensible size, too.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Merges a busy user's events into sessions before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Streaming state on local disk instead of on the heap. Jobs are started for what has arrived, and stop: the checkpoint gets the
    # files of the state that are new, which the next start opens, and not a changelog, all of which it would apply again.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    # Counting the rows of the state takes one more lookup for every row that is put there.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # What an action shuffled goes when it ends; otherwise it stays on the executors' disks until the driver happens to collect its
    # garbage, which on a large heap is never while a job runs.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Messages in particular take little more than half of what they take by the default, and no more time.
    "spark.sql.parquet.compression.codec": "zstd",
}


# Upper bounds on what one task is given, so that sorts and hash tables of a task stay in memory however large the tables are.
# Small stored rows grow to ten times their size and more in memory. A session's own smaller values stay.
TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


def _bytes(size: str) -> int:
    """A size as Spark writes it: ``67108864b``, ``16m``, ``1GB``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    for name, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, f"{most}b")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_folders: dict[str, str] = {}


def use_work_folder(spark: SparkSession, folder: str) -> None:
    """Name the folder for intermediate tables of a session whose cluster names none (``spark.checkpoint.dir``)."""
    _folders[spark.sparkContext.applicationId] = folder


def work_folder(spark: SparkSession) -> str | None:
    """The folder the cluster shares, else the one given to :func:`use_work_folder`."""
    return spark.conf.get("spark.checkpoint.dir", None) or _folders.get(spark.sparkContext.applicationId)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`work_folder`."""
    base = work_folder(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster, or call use_work_folder")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def side_by_side(tasks: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent Spark actions at the same time, so that one's last tasks do not leave the cluster idle."""
    keeps_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(tasks)))) as pool:
        started = {name: pool.submit(keeps_session(task)) for name, task in tasks.items()}
        return {name: future.result() for name, future in started.items()}
