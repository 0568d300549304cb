"""Session defaults and the shared folder in which intermediate tables are kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")

CHECKPOINT_CONF = "spark.checkpoint.dir"

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

SHUFFLE_BYTES = 1 << 30

#: Written tables are packed tighter than by default: they are written once, and written bytes are what a rebuild costs most.
PACKED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

#: Compressed bytes that a task reads at once where it keeps whole rows in memory.
SPLIT_BYTES = 16 << 20

_fine_lock, _fine = Lock(), {"blocks": 0, "before": None}
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_local_folders: dict[str, str] = {}


def build_session(name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the package defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the number of shuffle partitions to one per gigabyte of delimited text.

    Typed and compressed, that is about 256 MB of shuffled rows. Adaptive execution merges
    partitions that turn out small but never adds any, so the number has to fit the largest
    shuffle, which moves whole rows. It is never lowered.
    """
    wanted = -(-input_bytes // SHUFFLE_BYTES)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """:func:`size_shuffles` for one job; the session's own setting comes back afterwards."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        yield size_shuffles(spark, input_bytes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _split_bytes(spark: SparkSession) -> int:
    """Bytes of a split at most, by the session's setting."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def in_few_tasks(read: DataFrame) -> DataFrame:
    """Where splits are much smaller than ``SPLIT_BYTES``, tasks that read several of them, at least one task per core.

    Rows of a split stay together and in order; nothing is shuffled. A task for every small split would cost more than its rows.
    """
    spark = read.sparkSession
    per_task = SPLIT_BYTES // _split_bytes(spark)
    if per_task < 2:
        return read
    tasks = -(-read.rdd.getNumPartitions() // per_task)
    return read.coalesce(max(tasks, spark.sparkContext.defaultParallelism))


@contextmanager
def fine_splits(spark: SparkSession) -> Iterator[None]:
    """Files are read in splits of at most ``SPLIT_BYTES`` by the jobs started inside the block.

    For aggregations of whole rows: a task holds the distinct rows of its split before they are shuffled, and writes
    them to disk and back where they outgrow its memory. Blocks may overlap; the last one to end restores the setting.
    """
    name = "spark.sql.files.maxPartitionBytes"
    with _fine_lock:
        if not _fine["blocks"]:
            _fine["before"] = spark.conf.get(name)
            spark.conf.set(name, f"{min(_split_bytes(spark), SPLIT_BYTES)}b")
        _fine["blocks"] += 1
    try:
        yield
    finally:
        with _fine_lock:
            _fine["blocks"] -= 1
            if not _fine["blocks"]:
                spark.conf.set(name, _fine["before"])


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local run without the setting gets a folder of its own. On a cluster the
    setting is required, because a machine-local folder dies with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tenderlake-")
    return _local_folders[app]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{purpose}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at a durable table."""
    spark = df.sparkSession
    path = new_folder(spark, "staged")
    if (kept := _scratch.get()) is not None:
        kept.append(path)
    df.write.options(**PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends, whichever way it ends.

    For jobs that write their result elsewhere: frames built on staged tables do not
    outlive the block.
    """
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            delete_path(spark, path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path; 0 if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def side_by_side(spark: SparkSession, jobs: dict[str, Callable[[], R]]) -> dict[str, R]:
    """Run independent actions at the same time, so that small ones do not wait in line."""
    with ThreadPoolExecutor(max_workers=len(jobs) or 1) as pool:
        started = {
            name: pool.submit(copy_context().run, inheritable_thread_target(spark)(job))
            for name, job in jobs.items()
        }
        return {name: running.result() for name, running in started.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
