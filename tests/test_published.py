"""Tables that are written beside what is there and then switched to."""

import os

import pytest
from pyspark.sql import types as T

from suretygraph.published import Published, is_published
from suretygraph.storage import file_names, write_text

SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("day", T.StringType()), T.StructField("k", T.IntegerType())])


@pytest.fixture
def table(tmp_path):
    return Published(str(tmp_path / "t"), SCHEMA, ("day", "k"))


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def found(spark, table, **options):
    return sorted(tuple(r) for r in table.scan(spark, **options).collect())


def test_parts_replace_their_own(spark, table):
    assert found(spark, table) == [] and not is_published(spark, table.path)
    table.publish(rows(spark, (1, "a", 1), (2, "a", 2), (3, "b", 1)))
    table.publish(rows(spark, (4, "a", 2), (5, "c", 1)), info={"n": 1})
    assert found(spark, table) == [(1, "a", 1), (3, "b", 1), (4, "a", 2), (5, "c", 1)]
    assert found(spark, table, keep=lambda p: p["day"] == "a") == [(1, "a", 1), (4, "a", 2)]
    # Named parts go without new rows, and what was noted stays.
    table.publish(rows(spark), lambda p: p["day"] == "a")
    assert found(spark, table) == [(3, "b", 1), (5, "c", 1)] and table.snapshot(spark).info == {"n": 1}
    assert table.changed(spark, 2) == [{"day": "a", "k": "1"}, {"day": "a", "k": "2"}]
    assert table.changed(spark, 0) == [{"day": "b", "k": "1"}, {"day": "c", "k": "1"}]
    table.publish(rows(spark, (9, None, 7)), True)
    assert found(spark, table) == [(9, None, 7)]


def test_a_run_that_dies_changes_nothing(spark, table, monkeypatch):
    table.publish(rows(spark, (1, "a", 1)))
    monkeypatch.setattr("suretygraph.published.write_text", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.publish(rows(spark, (2, "a", 1), (3, "b", 1)))
    assert found(spark, table) == [(1, "a", 1)]
    assert len([n for n in os.listdir(table.path) if n.startswith("run=")]) == 2
    monkeypatch.undo()
    table.publish(rows(spark, (4, "b", 1)))
    assert found(spark, table) == [(1, "a", 1), (4, "b", 1)]
    assert len([n for n in os.listdir(table.path) if n.startswith("run=")]) == 2  # that of the dead run is gone


def test_a_reader_keeps_its_snapshot_for_one_more_run(spark, table):
    table.publish(rows(spark, (1, "a", 1), (2, "b", 1)))
    reader = table.scan(spark)
    table.publish(rows(spark, (3, "a", 1)))
    assert sorted(r.x for r in reader.collect()) == [1, 2]
    table.publish(rows(spark, (4, "a", 1)))
    runs = {r for r in table.snapshot(spark).folders.values()}
    first = table.snapshot(spark, 1).folders["day=a/k=1"]
    # The first run's day b is still current, its day a is not in the last two snapshots.
    assert first in runs and file_names(spark, f"{table.path}/run={first}") & {"day=a", "day=b"} == {"day=a", "day=b"}
    assert file_names(spark, f"{table.path}/run={first}/day=a/k=1") == set()
    assert found(spark, table) == [(2, "b", 1), (4, "a", 1)]


def test_a_table_without_parts_is_replaced_whole(spark, tmp_path):
    table = Published(str(tmp_path / "whole"), SCHEMA)
    for x in (1, 2, 3):
        table.publish(rows(spark, (x, "a", 1)), True)
        assert found(spark, table) == [(x, "a", 1)]
    table.publish(rows(spark), True)
    assert found(spark, table) == []
    table.note(spark, {"seen": 1})
    assert table.snapshot(spark).info == {"seen": 1} and found(spark, table) == []


def test_a_number_is_published_once(spark, table):
    table.publish(rows(spark, (1, "a", 1)))
    with pytest.raises(FileExistsError):
        write_text(spark, f"{table.path}/_snapshots/00000001.json", "{}")
    assert found(spark, table) == [(1, "a", 1)]
