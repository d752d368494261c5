"""Runs a registered query and its SQL and compares the rows as multisets."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sortable(row):
    return tuple((value is not None, str(value)) for value in row)


def rows_of_spark(df):
    order = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in order]).collect()), key=_sortable), order


def rows_of_duck(connection, sql):
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(names)
    at = [names.index(c) for c in order]
    return sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=_sortable), order
