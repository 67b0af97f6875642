"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kelpfit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where
    none is named, only a local session may fall back to a temporary folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="kelpfit-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like :func:`cut_lineage`, but as Parquet: rows are computed once and stay columnar."""
    spark, path = df.sparkSession, _new_path(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """Path in the folder that the driver and all executors see."""
    if spark.sparkContext.getCheckpointDir() is None:
        cut_lineage(spark.range(0))  # finds or refuses the folder
    return f"{spark.sparkContext.getCheckpointDir()}/{name}"


def _new_path(spark: SparkSession) -> str:
    return shared_path(spark, f"table-{uuid.uuid4().hex}")


@contextmanager
def dealt(df: DataFrame, column: str) -> Iterator[DataFrame]:
    """Written with a folder for each value of ``column``, so that a filter on it reads those only; then removed."""
    spark, path = df.sparkSession, _new_path(df.sparkSession)
    df.write.partitionBy(column).parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Not needed where it is installed on them or given with ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="kelpfit-")
    archive = shutil.make_archive(
        os.path.join(folder, "kelpfit"), "zip", os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a projected training table between passes; in memory, spilling to disk, if not told otherwise."""
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist()
