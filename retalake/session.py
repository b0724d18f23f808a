"""Session helpers and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Fixed value: codec of everything the library writes as parquet.
COMPRESSION = "zstd"


def local_session(name: str = "retalake", cpus: str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks on one machine. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_lock = threading.Lock()
#: Options set for blocks that run now: number of blocks and the value before the first of them.
_held: dict[tuple[int, str, str], tuple[int, str | None]] = {}


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a runtime option for one block and put the old value back.

    Blocks in several threads of one session may hold the same value: the last one to end puts the old value back.
    """
    mine = (spark._jsparkSession.hashCode(), key, value)
    with _lock:
        blocks, before = _held.get(mine, (0, spark.conf.get(key, None)))
        _held[mine] = blocks + 1, before
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            blocks, before = _held.pop(mine)
            if blocks > 1:
                _held[mine] = blocks - 1, before
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Run-time planning on, also where a cluster has switched it off: it splits hot partitions."""
    with (
        session_conf(spark, "spark.sql.adaptive.enabled", "true"),
        session_conf(spark, "spark.sql.adaptive.skewJoin.enabled", "true"),
        session_conf(spark, "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true"),
    ):
        yield


@contextmanager
def open_partitions(spark: SparkSession) -> Iterator[None]:
    """A task that writes partitions keeps the files of a few open, and sorts only if it meets more.

    Rows that come gathered, or of a few years, are written as they come: no sort, so nothing to spill.
    """
    with session_conf(spark, "spark.sql.maxConcurrentOutputFileWriters", "32"):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write go as soon as it has ended, not with the driver's next garbage.

    For writes of a data frame. Spark does not do it for an INSERT, see :func:`release_shuffles`.
    """
    with session_conf(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def release_shuffles(spark: SparkSession) -> None:
    """Let the files of finished shuffles go.

    Spark removes them when the driver collects what refers to them, which a driver with memory to spare does every
    ``spark.cleaner.periodicGC.interval``, half an hour. Until then a run's shuffles add up on the executors' disks.
    """
    spark.sparkContext._jvm.java.lang.System.gc()


def together(spark: SparkSession, jobs: list[Callable[[], T]]) -> list[T]:
    """Submit independent jobs at the same time, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [one.result() for one in started]


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as the cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retalake-"))
    return spark.sparkContext.getCheckpointDir()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system that Spark itself would use for it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


class Scratch:
    """Written intermediate tables of one run, under the shared folder.

    A table that has been written is not recomputed when an executor is lost,
    and what was evaluated while writing it (row positions, say) stays fixed.
    As a context manager it removes its tables at the end; results that still
    read from them have to be written before that. Else they go when the
    driver ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/retalake-{uuid.uuid4().hex}"
        self.made = False

    def path(self, name: str) -> str:
        """Place of a table. The folder is made at the first call, since only an existing one can be marked to go."""
        if not self.made:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
            system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            system.mkdirs(path)
            system.deleteOnExit(path)
            self.made = True
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        with shuffles_dropped(df.sparkSession):
            df.write.option("compression", COMPRESSION).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def remove(self) -> None:
        """Remove all tables, which nothing may read any more."""
        if self.made:
            remove_folder(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc: object) -> None:
        self.remove()
