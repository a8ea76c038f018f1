"""Session settings and the shared folder that intermediate results go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "snapstar", **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # Small shuffles still use every core of one machine.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a session of one machine may go without.

    Such a session (bench, a first try) uses the temporary folder of its machine, which all its
    tasks share.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="snapstar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path of its own inside the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settled(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and kept in the shared folder, so lost executors cost nothing."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


#: Rows of whole texts that go to a Python worker at once.
TEXTS_AT_ONCE = 1000
_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside pass texts to Python in small batches; the session's own setting returns after.

    A batch is held several times over, by the executor and by each of its workers, which keep the
    memory for the jobs that follow. A session with smaller batches keeps its own.
    """
    held = spark.conf.get(_AT_ONCE)
    if 0 < int(held) <= TEXTS_AT_ONCE:
        yield
        return
    spark.conf.set(_AT_ONCE, str(TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(_AT_ONCE, held)


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Jobs inside give their shuffle files back when they end; the session's own setting returns after.

    Otherwise the files stay until the driver collects its garbage. For rows that are written and
    read from the files from then on: whoever runs the same plan again deals its rows again.
    """
    held = spark.conf.get(_RELEASE)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, held)
