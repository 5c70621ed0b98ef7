"""Session settings the plans rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The folder of the innermost ``scratch``, if any.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)
#: Whether Spark deletes a query's shuffle files at the query's end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set what the plans need on a session somebody else created.

    Wall-clock text is produced by formatting, so the zone has to be UTC before
    a plan is analysed. The remaining settings are Spark's own adaptive
    features, stated because skew handling depends on them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # split a skewed join even where an aggregate on its keys follows
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def local_session(cores: str = "8", app: str = "vitalgrid") -> SparkSession:
    """A session for tests and for the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (a test on one machine) a fresh folder of our own is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"vitalgrid-{os.getpid()}")
    os.makedirs(folder, exist_ok=True)
    return folder


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """A block whose queries delete their shuffle files as they end; else these stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, *by: str, lasting: bool = False, home: str | None = None) -> DataFrame:
    """Write a result to the shared folder and go on from the written table.

    For results that several later plans use: they are computed once, and a
    lost executor costs a read instead of a recomputation. Inside ``scratch``
    the table goes when the block ends, unless it is ``lasting`` or is written
    to the ``home`` of an outer block.
    """
    spark = df.sparkSession
    home = home or (None if lasting else _SCRATCH.get()) or shared_folder(spark)
    path = f"{home}/settled-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*by) if by else df.write
    with _tidy(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A block whose settled tables are deleted at its end.

    What leaves the block must not read them any more: settle it as lasting.
    """
    folder = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        remove(spark, folder)


def size_shuffles(spark: SparkSession, input_bytes: int, per_task: int = 200 << 20) -> int:
    """Shuffle partitions for an input size: about 200 MB a task.

    A fixed number is either too small for 100 TB (tasks that spill) or too
    large for a test. Adaptive execution still merges small ones.
    """
    least = spark.sparkContext.defaultParallelism
    partitions = max(least, min(200_000, -(-input_bytes // per_task)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions
