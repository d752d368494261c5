"""Running sums in groups of any size: range partitions, none of which has to hold a group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph.llm.arrow import arrow_map, longs
from suretygraph.llm.staging import stored
from suretygraph.llm.tokens import U

def running_sums(df: DataFrame, group: str, order: list[Column], terms: list[str]) -> DataFrame:
    """Adds to each row the sums of its group's terms up to it (``name_sum``) and before it (``name_before``).

    Terms are longs without nulls, sums wrap at 64 bits, ``group`` has no nulls. A group may be of any size: rows are sorted
    by range partitions of (group, order), summed there and written. Only the last group of a partition goes on in the next,
    so the driver gets one row of sums for each partition and every row of a partition's first group is raised by what came
    before. Other columns pass through; none may start with an underscore.
    """
    outputs = [c for name in terms for c in (f"{name}_sum", f"{name}_before")]
    schema = T.StructType([
        *df.schema.fields, *[T.StructField(c, T.LongType()) for c in outputs], T.StructField("_part", T.IntegerType()),
        T.StructField("_at", T.LongType())])

    def local(batches):
        part, at, current, carried = TaskContext.get().partitionId(), 0, None, [U(0)] * len(terms)
        for rows in batches:
            n = rows.num_rows
            if n == 0:
                continue
            keys = rows.column(group)
            new = np.ones(n, bool)
            new[1:] = np.asarray(pc.not_equal(keys[1:], keys[:-1]))
            new[0] = keys[0].as_py() != current
            heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            columns, starts_old = [], np.cumsum(new) == 0
            for i, name in enumerate(terms):
                values = rows.column(name).to_numpy().astype(np.int64).view(U)
                total = np.cumsum(values)
                before = total - values
                before = before - np.where(starts_old, U(0), before[heads]) + np.where(starts_old, carried[i], U(0))
                columns += [longs(before + values), longs(before)]
                carried[i] = (before + values)[-1]
            current = keys[n - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *columns, pa.array(np.full(n, part, np.int32)), longs(np.arange(at, at + n))], schema.names)
            at += n

    spread = df.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    rows = stored(arrow_map(spread, local, schema), "running")
    last = F.max_by(F.struct(*[f"{name}_sum" for name in terms]), "_at")
    parts = rows.groupBy("_part").agg(F.min(group).alias("first"), F.max(group).alias("last"), last.alias("sums")).orderBy("_part").collect()
    raised, goes_on, so_far = {}, None, [0] * len(terms)
    for p in parts:
        before = so_far if p.first == goes_on else [0] * len(terms)
        if any(before):
            raised[p["_part"]] = (p.first, before)
        so_far = [(a if p.first == p.last else 0) + int(b) for a, b in zip(before, p.sums)]
        goes_on = p.last

    def globally(batches):
        for rows in batches:
            columns = {c: rows.column(c).to_numpy().view(U) for c in outputs}
            part = rows.column("_part").to_numpy()
            for p in set(part.tolist()) & raised.keys():
                key, sums = raised[p]
                hit = (part == p) & np.asarray(pc.equal(rows.column(group), pa.scalar(key, rows.column(group).type)))
                for name, more in zip(terms, sums):
                    for c in (f"{name}_sum", f"{name}_before"):
                        columns[c] = columns[c] + np.where(hit, U(more % (1 << 64)), U(0))
            own = [rows.column(c) if c not in columns else longs(columns[c]) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays(own, schema.names[:-2])

    return arrow_map(rows, globally, T.StructType(schema.fields[:-2]))
