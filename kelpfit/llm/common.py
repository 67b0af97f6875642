"""Helpers that the text operators share: row numbers, stored tables, packed rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, as a Java and Python character class.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors see.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session that names none gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="kelpfit-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Short rows in a file of a stored table whose number of rows is bounded.
FILE_ROWS = 500_000


def stored(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: executors lost later read the files again. Unlike
    ``checkpoint()``, the rows are computed once and stay columnar. Where ``most`` bounds
    the number of (short) rows, they are written by as few tasks as that many rows need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if most is not None:
        df = df.coalesce(max(1, -(-most // FILE_ROWS)))
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget_stored(spark: SparkSession) -> None:
    """Delete the tables written so far; their results must have been saved or read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def numbered(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Add a row number that tells repeated rows apart.

    It is the place of the row in its input partition, so it repeats when a task
    runs again, or another job reads the same files or the same stored table. Rows
    that come from a shuffle have no fixed order: pass them through :func:`stored`
    first. How files are split must not follow the number of cores, which falls when
    executors are lost, so the session's number is pinned on first use.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.files.minPartitionNum", None) is None:
        conf.set("spark.sql.files.minPartitionNum", str(df.sparkSession.sparkContext.defaultParallelism))
    return df.withColumn(name, F.monotonically_increasing_id())


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct ``_row``, so that no name can clash with a helper's."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unpacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def text_of(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def hex_sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)
