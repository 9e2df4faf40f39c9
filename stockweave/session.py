"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections import deque
from collections.abc import Callable
from concurrent.futures import Future
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Session settings the plans rely on. AQE turns shuffle joins into broadcast
# joins once the real size is known and splits skewed join partitions, so no
# plan here needs a size guess of its own.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str = "*", partitions: int = 8, app: str = "stockweave") -> SparkSession:
    """A single-machine session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.gettempdir() + "/stockweave-warehouse")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _scratch() -> str:
    """One temporary folder per process for local sessions, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="stockweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _scratch()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df, purpose: str = "stage", by: tuple = ()):
    """Write a frame to the shared folder and read it back.

    Used where one result feeds many reports: the readers scan columnar files
    instead of replaying the joins, and a lost executor costs a re-read only.
    ``by`` splits the files, for readers that want one part.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.mode("errorifexists").partitionBy(*by).parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


#: Steps that run at a time in this process, however calls of ``together`` are nested: all of them plan in the driver's memory.
JOBS_AT_ONCE = 2
_helpers = threading.BoundedSemaphore(JOBS_AT_ONCE - 1)


def together(*steps: Callable) -> list:
    """Results of steps that do not depend on each other, in their order; their jobs share the executors.

    A small job leaves most cores idle and a planned one waits for the driver,
    so steps one after the other take the sum of those waits. The caller works
    on the steps itself, with whatever helpers are free just now. Every step
    ends before the first failure, by order, is raised.
    """
    todo, ended = deque(enumerate(steps)), {}

    def work() -> None:
        while todo:
            try:
                i, step = todo.popleft()
            except IndexError:  # another one took the last step
                return
            ended[i] = Future()
            try:
                ended[i].set_result(step())
            except Exception as why:
                ended[i].set_exception(why)

    def help_out() -> None:
        try:
            work()
        finally:
            _helpers.release()

    helping = []
    while len(helping) + 1 < len(steps) and _helpers.acquire(blocking=False):
        helping.append(threading.Thread(target=inheritable_thread_target(SparkSession.active())(help_out)))
        helping[-1].start()
    work()
    for helper in helping:
        helper.join()
    return [ended[i].result() for i in range(len(steps))]
