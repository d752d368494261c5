"""Tables written between the steps of an operator, and joins with sides of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.storage import staging_folder

#: Arrow batches sent to Python workers hold at most so many bytes, so that long texts can't fill a worker.
BATCH_BYTES = 8 << 20


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as Parquet into the shared folder and returns them read back: work before this point
    isn't repeated by later readers or after the loss of an executor."""
    spark = session_of(df)
    path = f"{staging_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to BATCH_BYTES; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def small(df: DataFrame, rows: int) -> bool:
    """Whether a stored table has at most so many rows; it never counts further than that."""
    return df.limit(rows + 1).count() <= rows


def with_small(df: DataFrame, side: DataFrame, on, how: str = "inner", rows: int = 100_000) -> DataFrame:
    """Joins a stored side: broadcast where it has at most ``rows`` rows, else left to the optimizer."""
    return df.join(F.broadcast(side) if small(side, rows) else side, on, how)
