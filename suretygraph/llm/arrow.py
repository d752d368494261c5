"""Small helpers for functions over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.staging import bounded_batches, session_of

Batches = Iterator[pa.RecordBatch]


def arrow_map(df: DataFrame, function: Callable[[Batches], Batches], schema: str | T.StructType) -> DataFrame:
    bounded_batches(session_of(df))
    return df.mapInArrow(function, schema)


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def long_lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), longs(flat))


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def row_of(df: DataFrame, but: Collection[str] = ()) -> Column:
    """All columns of a table as one struct, so that none of their names meets one that an operator uses."""
    left_out = {c.lower() for c in but}
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in left_out])


def put(df: DataFrame, row: str, *columns: str) -> DataFrame:
    """Opens the struct of a table's own columns again; new columns replace those of the same name."""
    new = {c.lower() for c in columns}
    own = [f.name for f in df.schema[row].dataType.fields if f.name.lower() not in new]
    return df.select(*[F.col(row).getField(c).alias(c) for c in own], *[F.col(c) for c in columns])
