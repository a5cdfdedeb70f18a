"""The shared folder for data that has to outlive the executor that made it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STAGING = "siltstone_staging"
PACKED = "zstd"  #: of files with ids: 64 hexadecimal digits are packed into half, which snappy leaves as they are


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Tasks write up to ``files`` partitions side by side in the block, instead of sorting all their rows by partition first.

    Rows that were gathered by month meet few months in a task. Of a task with more, only the rest is sorted. A number
    that the session has set stays.
    """
    if spark.conf.get(WRITERS, None) is not None:
        yield
        return
    spark.conf.set(WRITERS, files)
    try:
        yield
    finally:
        spark.conf.unset(WRITERS)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose one machine is the whole cluster, may fall back to a folder made
    for the purpose.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor reaches")
    made = tempfile.mkdtemp(prefix="siltstone-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once and read back, for as long as the shared folder keeps it."""
    folder = fresh_folder(df.sparkSession, label)
    writer = df.write.option("compression", PACKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_writes(df.sparkSession):
        writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder, wherever that is; nothing where it does not exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(found.getPath()) for found in system.listStatus(place)] if system.exists(place) else []


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that a run made, wherever it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder that is dropped again after the block.

    Several writes then do not compute ``df`` several times, and a write that replaces an input of
    ``df`` no longer reads it.
    """
    spark = df.sparkSession
    spark.sql(
        f"CREATE SCHEMA IF NOT EXISTS {STAGING} LOCATION '{shared_folder(spark)}/{STAGING}'"
    )
    table = f"{STAGING}.{label}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", PACKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        with unsorted_writes(spark):
            writer.saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
