"""Tables written between steps."""

import time

from conftest import SF
from pyspark.sql import functions as F

from suretygraph.plans import catalog
from suretygraph.published import Published
from suretygraph.sources import files, tables
from suretygraph.storage import SHUFFLES_GO, shuffles_go, staging_folder, written


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def left_by(spark, work):
    """The shuffle files that are still there; they may go a moment after the work has ended."""
    before = shuffle_files(spark)
    result = work()
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return result, left


def test_a_written_table_leaves_no_shuffle_files(spark):
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    table, left = left_by(spark, lambda: written(counts))
    assert not left
    assert table.agg(F.sum("count")).first()[0] == 10_000


def test_a_published_table_leaves_no_shuffle_files(spark):
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    table = Published(staging_folder(spark), counts.schema, ("k",))
    _, left = left_by(spark, lambda: table.publish(counts))
    assert not left
    assert table.scan(spark).agg(F.sum("count")).first()[0] == 10_000


def test_the_session_keeps_its_setting(spark):
    now = spark.conf.get(SHUFFLES_GO)
    try:
        with shuffles_go(spark):
            assert spark.conf.get(SHUFFLES_GO) == "true"
            raise KeyError
    except KeyError:
        assert spark.conf.get(SHUFFLES_GO) == now


def test_deliveries_are_compressed_and_leave_no_shuffle_files(spark):
    rows, root, store = tables.transactions(spark, SF), staging_folder(spark), staging_folder(spark)
    _, left = left_by(spark, lambda: catalog._deliver(rows, root))
    assert not left
    assert {r.file.rsplit(".", 2)[-2:] == ["csv", "gz"] for r in files.delivered_files(spark, root).collect()} == {True}
    taken, left = left_by(spark, lambda: files.take_in(spark, root, store, tasks=4))
    assert taken.lines == rows.count() and not taken.rejected
    back = files.scan_taken_in(spark, store).select(rows.columns)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
