"""Session and scratch-space helpers.

Library functions never build their own session; they take the caller's.
``local_session`` exists for tests and ``bench.py`` only.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Folders that a writing task holds open at once.
OPEN_FOLDERS = 8
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings every job of this package assumes. Times are compared and
# formatted in UTC; ANSI mode keeps bad casts and index errors loud.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    _WRITERS: str(OPEN_FOLDERS),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sigshape", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to a shared file system (an unset
    value raises there). Only in local mode, when it is unset (tests), a
    fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                               "(a machine-local temp folder does not survive executor loss)")
        root = tempfile.mkdtemp(prefix="sigshape-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the checkpoint root for one run. Spark's
    writers create it, on whichever file system the root is."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def job_path(spark: SparkSession, name: str) -> str:
    """A stable sub-path of the checkpoint root (same on every restart), for
    a long-running job's stream checkpoint."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/{name}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a ``scratch_path`` that no frame in use reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes into few folders (topics, batches) hold a file open for each
    instead of sorting, and spilling, every task's rows by folder. From the
    ninth folder on, a task sorts the rest. A caller's own setting is kept."""
    before = spark.conf.get(_WRITERS, None)
    if int(before or 0):
        yield
        return
    spark.conf.set(_WRITERS, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write go when it ends; Spark would keep them
    until the driver collects its garbage. For actions on frames that are not
    used again (their shuffles would run once more)."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)
