"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
#: Folders that ``written`` made and nobody has deleted yet, oldest first.
FOLDERS: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a session on one machine (tests, a laptop) without that setting gets a
    temporary folder of its own, for the rest of the session; a cluster must
    name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tesserae-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    FOLDERS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remove(df: DataFrame) -> None:
    """Delete the files behind a frame that ``written`` returned."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, path)
        FOLDERS[:] = [x for x in FOLDERS if x.rsplit("/", 1)[-1] != path.rsplit("/", 1)[-1]]


def release(spark: SparkSession, since: int) -> None:
    """Delete the folders that ``written`` made from the ``since``-th on, but for the last, whose making needed them."""
    for path in FOLDERS[since:-1]:
        delete(spark, path)
    del FOLDERS[since:-1]


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, made longer until none of the frames has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_cycles(batches: Iterable[T]) -> Iterator[T]:
    """The batches of a Python task with the cycle collector off, as large caches make its passes long; freed memory goes back at the end."""
    on = gc.isenabled()
    gc.disable()
    return_large_blocks()
    try:
        yield from batches
    finally:
        if on:
            gc.enable()
        give_back()


class Kept:
    """One value for all tasks of a Python worker, such as a model and what it has cached; let go when no task has used it for a while.

    Workers are reused and would hold it through all later stages of a job.
    """

    def __init__(self, make: Callable, idle_seconds: float = 4.0):
        self.make, self.idle, self.lock = make, idle_seconds, threading.Lock()
        self.key = self.value = self.timer = None
        self.users = 0

    @contextlib.contextmanager
    def use(self, *key):
        with self.lock:
            if self.timer:
                self.timer.cancel()
            if self.value is None or self.key != key:
                self.key, self.value = key, self.make(*key)
            self.users += 1
            value = self.value
        try:
            yield value
        finally:
            with self.lock:
                self.users -= 1
                self.timer = threading.Timer(self.idle, self.let_go)
                self.timer.daemon = True
                self.timer.start()

    def let_go(self) -> None:
        with self.lock:
            if self.users:
                return
            self.key = self.value = None
        give_back()


def return_large_blocks(size: int = 8 << 20) -> None:
    """Make blocks of ``size`` bytes or more go back to the system as soon as they are freed."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL("libc.so.6").mallopt(-3, size)  # M_MMAP_THRESHOLD, which else grows with what is freed
    except (OSError, AttributeError):  # another C library
        pass


def give_back() -> None:
    """Return freed memory to the system: reused Python workers would hold it for the rest of the job."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_hot(rows: DataFrame, groups: DataFrame, key: str, count: str, most: int = 1000) -> DataFrame:
    """Left join of ``rows`` with ``groups`` (one row a key) when a few keys hold many rows.

    ``groups`` carries the number of its rows in ``count``.  Keys with more
    than a ``most``-th of all rows are fewer than ``most``, so those alone are
    broadcast; the rest, none of which can fill a task, meet in a shuffle join.
    """
    limit = groups.agg((F.coalesce(F.sum(count), F.lit(0)) / most + 1).alias("n")).first()["n"]
    hot = groups.where(F.col(count) > limit)
    cold = groups.where(F.col(count) <= limit)
    names = [c for c in groups.columns if c != key]
    packed = F.struct(*names)
    out = rows.join(F.broadcast(hot.select(key, packed.alias("_hot"))), key, "left")
    is_hot = F.col("_hot").isNotNull()
    near = out.where(is_hot).withColumn("_g", F.col("_hot"))
    far = out.where(~is_hot).join(cold.select(key, packed.alias("_g")), key, "left")
    both = near.unionByName(far)
    return both.select(*rows.columns, *[F.col(f"_g.{c}").alias(c) for c in names])
