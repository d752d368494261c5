"""Folders of the cluster's file system.

The only place that reaches for Hadoop's file system through the session's JVM; it isn't there under Spark Connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, folder: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """What lies directly in a folder; nothing if there is none."""
    system, location = file_system(spark, folder)
    return {f.getPath().getName() for f in system.listStatus(location)} if system.exists(location) else set()


def read_text(spark: SparkSession, file: str) -> str:
    system, location = file_system(spark, file)
    stream = system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """Writes a small file that isn't there yet; it appears whole or not at all."""
    system, location = file_system(spark, file)
    _, beside = file_system(spark, f"{location.getParent()}/.{location.getName()}-{uuid4().hex}")
    stream = system.create(beside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(location) or not system.rename(beside, location):
        system.delete(beside, False)
        raise FileExistsError(f"{file} was written by somebody else")


def remove(spark: SparkSession, folder: str) -> None:
    system, location = file_system(spark, folder)
    system.delete(location, True)


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else the warehouse. A warehouse on local disk is refused where
    executors run on other machines: each would write to its own, and a later read would miss rows."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir")
    system, _ = file_system(spark, root)
    if system.getUri().getScheme() == "file" and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return root.rstrip("/")


def staging_folder(spark: SparkSession) -> str:
    """A folder not yet there, for a table that is written and read back; it goes when the application ends."""
    folder = f"{shared_root(spark)}/suretygraph-{uuid4().hex}"
    system, location = file_system(spark, folder)
    system.mkdirs(location)
    system.deleteOnExit(location)
    return f"{folder}/data"


#: Whether a query's shuffle files go when it ends, not when the driver happens to collect the garbage that stands for them.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files. For rows that are read back from where they were written: a job of several
    steps then holds the shuffles of one step at a time. The session's setting is as before afterwards."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def written(df: DataFrame) -> DataFrame:
    """Read back from a staging folder: what it comes from is worked out once, whoever reads it."""
    folder = staging_folder(df.sparkSession)
    with shuffles_go(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
