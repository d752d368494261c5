import json
from datetime import date

import pytest

from suretygraph.operators import vendors
from suretygraph.sinks import parquet as sink
from suretygraph.sources import files


@pytest.fixture
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out") / "table")


def days(spark, root):
    return {r.transaction_day.day: r["count"] for r in files.scan_edges(spark, root).groupBy("transaction_day").count().collect()}


def data_files(root):
    import glob

    return sorted(path.split("/")[-2] for path in glob.glob(f"{root}/*/*.parquet"))


def week(edges, *skip, first=1, last=7, times=3):
    return edges(*[("A", f"B{i}", i + 1, d) for d in range(first, last + 1) if d not in skip for i in range(times)])


def test_one_file_per_day_and_reruns_are_equal(spark, edges, root):
    for _ in range(2):
        sink.save_edges(week(edges), root, "2026-05-07")
        assert data_files(root) == [f"transaction_day=2026-05-0{d}" for d in range(1, 8)]
        assert days(spark, root) == {d: 3 for d in range(1, 8)}


def test_a_run_owns_its_window_only(spark, edges, root):
    sink.save_edges(week(edges, last=10), root)
    sink.save_edges(week(edges, 4, 5, first=3, last=9, times=1), root, "2026-05-09")
    assert days(spark, root) == {1: 3, 2: 3, 3: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 3}
    sink.save_edges(week(edges).limit(0), root, "2026-05-09")
    assert days(spark, root) == {1: 3, 2: 3, 10: 3}


def test_a_full_run_keeps_days_it_has_no_rows_for(spark, edges, root):
    sink.save_edges(week(edges, last=9), root)
    sink.save_edges(edges(("A", "B", 1, 2), ("A", "C", 1, None)), root)
    stored = files.scan_edges(spark, root)
    assert {r.target_account_id for r in stored.filter("transaction_day = '2026-05-02'").collect()} == {"B"}
    assert stored.filter("transaction_day is null").count() == 1
    assert stored.count() == 8 * 3 + 2
    sink.save_edges(week(edges).limit(0), root)
    assert stored.count() == 8 * 3 + 2


def test_all_is_replaced_on_request_only(spark, edges, root):
    sink.save_edges(week(edges, last=9), root)
    sink.save_edges(edges(("A", "B", 1, 2), ("A", "C", 1, None)), root, replace_all=True)
    assert {(r.target_account_id, r.transaction_day) for r in files.scan_edges(spark, root).collect()} == {
        ("B", date(2026, 5, 2)), ("C", None)
    }
    with pytest.raises(ValueError):
        sink.save_edges(week(edges), root, "2026-05-07", replace_all=True)


def test_a_hot_day_is_split_and_kept_whole(spark, root):
    rows = spark.range(400_000).selectExpr(
        "sha2(cast(id as string), 256) AS source_account_id", "cast(id as string) AS target_account_id",
        "cast(1 as decimal(18,2)) AS guarantee_amount_usd",
        "date_add(date'2026-05-01', cast(if(id % 3 = 0, 0, id % 5) as int)) AS transaction_day",
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        sink.save_edges(rows, root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert data_files(root).count("transaction_day=2026-05-01") > 1
    assert sum(days(spark, root).values()) == 400_000


def test_a_set_number_of_tasks(spark, edges, root):
    hot = edges(*[("A", f"B{i}", 1, 1) for i in range(500)]).union(week(edges, first=2, last=20, times=5))
    sink.save_edges(hot, root, tasks=6, day_parts=4)
    assert data_files(root).count("transaction_day=2026-05-01") > 1
    assert len(data_files(root)) <= 20 * 4
    sink.save_edges(hot, root, tasks=6)
    assert len(data_files(root)) == 20
    assert days(spark, root) == {1: 500} | {d: 5 for d in range(2, 21)}


def test_edges_are_pruned_by_day(spark, edges, root):
    sink.save_edges(week(edges), root)
    part = files.scan_edges(spark, root, "2026-05-02", date(2026, 5, 3))
    assert part.count() == 6


def test_vendor_files(spark, root):
    frame = spark.createDataFrame(
        [("V1", "n", "CL", "t", "e", "d.example"), ("V2", "n", "CL", None, "e", None)],
        "vendor_id string, legal_name string, country string, tax_id_pii string, search_api_endpoint string, domain string",
    )
    for run_date, folder in ((None, "day=unknown"), ("2026-05-07", "day=2026-05-07")):
        rows = vendors.enriched_vendors(frame, salt="s", run_date=run_date)
        sink.save_vendors(rows, f"{root}/p", run_date)
        sink.save_vendors_json(rows, f"{root}/j", run_date)
        assert files.scan_enriched_vendors(spark, f"{root}/p", run_date).count() == 2
        text = spark.read.text(f"{root}/j/{folder}").collect()
        records = {r["vendor_id"]: r for r in (json.loads(t.value) for t in text)}
        assert records["V2"]["official_domain"] is None and records["V2"]["tax_id_sha256"] is None
        assert "tax_id_pii" not in records["V1"] and records["V1"]["execution_date"] == run_date
    sink.save_vendors(vendors.enriched_vendors(frame.limit(0), salt="s", run_date="2026-05-07"), f"{root}/p", "2026-05-07")
    assert files.scan_enriched_vendors(spark, f"{root}/p", "2026-05-07").count() == 0
    assert files.scan_enriched_vendors(spark, f"{root}/p").count() == 2


def test_graph_tables(spark, edges, root):
    sink.save_graph(edges(("A", "B", 1, 1), ("A", "B", 2, 2)), f"{root}/g1")
    sink.save_graph(edges(("A", "B", 9, 1), ("B", "C", 1, 1)), f"{root}/g2", files.scan_edges(spark, f"{root}/g1/edges"))
    stored = {tuple(r)[:2] + (float(r[2]),) for r in files.scan_edges(spark, f"{root}/g2/edges").collect()}
    assert stored == {("A", "B", 2.0), ("B", "C", 1.0)}
    assert sorted(r.id for r in spark.read.parquet(f"{root}/g2/nodes").collect()) == ["A", "B", "C"]
