"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None
_written: list[str] = []


def get_spark(
    app: str = "popflow", master: str | None = None, partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the package is designed for; an existing one is reused.

    ``partitions`` is the number that shuffles start from. Adaptive execution merges small ones
    but makes none: set it to the bytes of the largest input over about 128 MB.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one machine, may fall back to a folder of its own.
    """
    global _local_scratch
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="popflow-")
    return _local_scratch.name


def new_path(spark: SparkSession) -> str:
    """An unused path in the shared folder; ``release`` deletes what is written there."""
    path = f"{shared_folder(spark)}/popflow-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no lineage beyond the files, so a lost executor never re-runs the plan that
    produced it, and values such as partition numbers are fixed once and for all.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Delete one table ``cut`` wrote, once nothing reads it any more."""
    spark, files = table.sparkSession, table.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if path.getName().startswith("popflow-"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables ``cut`` wrote inside, and none of those written before."""
    start = len(_written)
    try:
        yield
    finally:
        release(spark, start)


def release(spark: SparkSession, start: int = 0) -> int:
    """Delete the tables ``cut`` wrote; call it once no result depends on them any more.

    ``start`` keeps that many of the first ones, those of other jobs of the process.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    while len(_written) > start:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += bool(path.getFileSystem(hadoop).delete(path, True))
    return count
