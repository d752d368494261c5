"""The whole sequence on files shaped like a week of operation."""

import csv
import gzip
import json
import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import plan_of

from suretygraph import schemas
from suretygraph.plans import jobs
from suretygraph.published import Published
from suretygraph.sources import files

START = date(2026, 5, 1)
FIELDS = "transaction_id source_account_id target_account_id guarantee_amount_usd fee_amount_usd status timestamp country_code".split()


def ring_amount(day):
    return 1000 * (5 if day >= 4 else 1)


@pytest.fixture
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("week")
    for n in range(7):
        day = START + timedelta(n)
        folder = root / "transactions" / f"day={day}"
        folder.mkdir(parents=True)
        rows = [(f"T{n}_{i}", f"ACC_{300 + i}", f"ACC_{400 + i}", 60000 if i == 0 else 100, 2, "APPROVED", f"{day} 12:00:00", "CL")
                for i in range(4)]
        rows += [(f"R{n}_{i}", f"ACC_10{i + 1}", f"ACC_10{(i + 1) % 3 + 1}", ring_amount(n), 20, "APPROVED", f"{day} 01:00:00", "PE")
                 for i in range(3) if n >= 2]
        rows += [(f"S{n}_{i}", f"ACC_20{i + 1}", f"ACC_20{(i + 1) % 3 + 1}", ring_amount(n), 20, "APPROVED", f"{day} 01:00:00", "PE")
                 for i in range(3) if n >= 2]
        rows += [(f"D{n}", "ACC_300", "ACC_400", 5, 1, "DECLINED", f"{day} 01:00:00", "CL"),
                 (f"Z{n}", "ACC_300", "ACC_400", 0, 1, "APPROVED", f"{day} 01:00:00", "CL")]
        with open(folder / "transactions.csv", "w", newline="") as out:
            csv.writer(out).writerows([FIELDS, *rows])
    with gzip.open(root / "free_accounts.csv.gz", "wt", newline="") as out:
        writer = csv.writer(out)
        writer.writerow("account_id account_name client_segment benefit_type activation_date".split())
        writer.writerows((f"ACC_{i}", "p", "SME", "WELCOME_OFFER", "2026-01-10") for i in range(100, 150))
    (root / "sap_vendors.json").write_text(json.dumps([
        {"vendor_id": f"VEN_{i}", "legal_name": name, "country": "CL", "tax_id_pii": f"1-{i}", "search_api_endpoint": f"lookup/{i}"}
        for i, name in enumerate(("Apex Finance Group Division 1 S.A.", "Nobody"))
    ]))
    return jobs.Paths(str(root / "transactions"), str(root / "free_accounts.csv.gz"), str(root / "sap_vendors.json"), str(root / "curated"))


def test_the_week(spark, data):
    counts, counters = jobs.run_all(spark, data, "2026-05-07", salt="s")
    assert counters is None
    values = {r.measure: int(r.value) for r in counts.collect()}
    # Three ring edges on five days and four others on seven; the promotional ring is gone.
    assert values == {"edge_count": 43, "cycle_count": 3}

    curated = files.scan_curated(spark, data.out("transactions"))
    assert curated.count() == 43
    assert {r.risk_category for r in curated.select("risk_category").distinct().collect()} == {"NORMAL", "HIGH"}
    assert not curated.filter("source_account_id like 'ACC_1%'").count()
    metrics = {r.transaction_day: tuple(r)[1:] for r in files.scan_risk_metrics(spark, data.out("risk_metrics")).collect()}
    assert metrics[date(2026, 5, 1)] == (4, 60300.0, 15075.0, 1)
    assert metrics[date(2026, 5, 7)] == (7, 75300.0, 75300.0 / 7, 1)
    assert files.scan_high_volume(spark, data.out("high_risk_accounts")).count() == 0
    vendor = {r.vendor_id: r.official_domain for r in files.scan_enriched_vendors(spark, data.out("enriched_vendors"), "2026-05-07").collect()}
    assert vendor == {"VEN_0": "apexfinance.cl", "VEN_1": "unknown-company.com"}


def test_incremental_runs(spark, data):
    def run(day):
        jobs.run_transactions(spark, data, day, processed_at=datetime(2026, 5, 9))
        edges = files.scan_edges(spark, data.out("graph_edges"))
        metrics = files.scan_risk_metrics(spark, data.out("risk_metrics"))
        return sorted(edges.collect()), {r.transaction_day.day for r in metrics.collect()}

    first, shown = run("2026-05-05")
    assert len(first) == 29 and shown == {1, 2, 3, 4, 5}
    second, shown = run("2026-05-09")
    # Days before the new window stay; metrics are those of the last window.
    assert len(second) == 43 and shown == {3, 4, 5, 6, 7}
    assert run("2026-05-09")[0] == second
    jobs.run_transactions(spark, data, "2026-05-20")
    assert sorted(files.scan_edges(spark, data.out("graph_edges")).collect()) == second
    assert files.scan_risk_metrics(spark, data.out("risk_metrics")).count() == 0


def test_late_rows_redeliveries_and_rejected_lines(spark, data):
    def deliver(day, *lines):
        folder = f"{data.transactions}/day={day}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/transactions.csv", "w") as out:
            out.write("\n".join([",".join(FIELDS), *lines]) + "\n")

    def ids():
        jobs.run_transactions(spark, data, "2026-05-07", again=again)
        return {r.transaction_id for r in files.scan_curated(spark, data.out("transactions"), "2026-05-07").collect()}

    again = []
    before = ids()
    deliver("2026-05-18", "LATE,ACC_900,ACC_901,70,1,APPROVED,2026-05-06 10:00:00,CL", "broken,ACC_1", "N,A,B,x,1,APPROVED,2026-05-06 10:00:00,CL")
    assert ids() == before | {"LATE"}  # twelve days late
    assert sorted((str(r.delivery), r.line[:6]) for r in files.scan_rejected(spark, data.out("rejected_lines")).collect()) == [
        ("2026-05-18", "N,A,B,"), ("2026-05-18", "broken")]
    deliver("2026-05-18", "LATER,ACC_900,ACC_901,70,1,APPROVED,2026-05-05 10:00:00,CL")
    assert ids() == before | {"LATER"}  # the file is another one now
    again = (d for d in ["2026-05-18"])
    assert ids() == before | {"LATER"}
    plan = plan_of(files.scan_taken_in(spark, data.out("intake"), "2026-05-07"))
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "transaction_day" in filters


def test_vendors_from_an_attempt_log(spark, data):
    log = spark.createDataFrame(
        [("VEN_0", datetime(2026, 5, 1), 1, 503, None), ("VEN_0", datetime(2026, 5, 2), 2, 200, '{"domain": "a.example"}')],
        "vendor_id string, attempted_at timestamp, attempt_id long, status_code int, response_body string",
    )
    counters = jobs.run_vendors(spark, data, salt="s", attempts=log)
    assert tuple(counters.first()) == (1, 0, 1, 0)
    stored = files.scan_enriched_vendors(spark, data.out("enriched_vendors")).collect()
    assert {(r.vendor_id, r.official_domain, r.enrichment_status) for r in stored} == {
        ("VEN_0", "a.example", "SUCCESS"), ("VEN_1", None, "FAILED")
    }
    copies = spark.read.json(data.out("enriched_vendors_json") + "/day=unknown").select(stored[0].__fields__).collect()
    assert sorted(map(tuple, copies), key=str) == sorted(map(tuple, stored), key=str)


def test_graph_is_merged_into_a_new_folder(spark, data, edges):
    from suretygraph.sinks import parquet as sink

    sink.save_edges(edges(("A", "B", 1, 1), ("B", "A", 1, 1)), data.out("graph_edges"))
    jobs.run_graph(spark, data, graph_path=data.out("g1"))
    sink.save_edges(edges(("B", "C", 1, 2), ("C", "A", 1, 2)), data.out("graph_edges"), replace_all=True)
    values = {r.measure: int(r.value) for r in jobs.run_graph(
        spark, data, graph_path=data.out("g2"), previous_graph=data.out("g1")).collect()}
    assert values == {"edge_count": 2, "cycle_count": 2 + 3}
    with pytest.raises(ValueError):
        jobs.run_graph(spark, data, graph_path=data.out("g2"), previous_graph=data.out("g2") + "/")


def test_a_window_of_edges_gives_the_graph_of_all(spark, data, edges):
    from suretygraph.sinks import parquet as sink

    first = [("A", "B", 1, 1), ("B", "A", 1, 2), ("C", "C", 1, 3)]
    sink.save_edges(edges(*first), data.out("graph_edges"))
    jobs.run_graph(spark, data, graph_path=data.out("g1"))
    sink.save_edges(edges(*first, ("A", "B", 7, 9), ("B", "C", 1, 9), ("C", "A", 1, 10)), data.out("graph_edges"))
    jobs.run_graph(spark, data, graph_path=data.out("all"))
    counts = jobs.run_graph(spark, data, "2026-05-10", graph_path=data.out("g2"), previous_graph=data.out("g1"))
    assert {r.measure: int(r.value) for r in counts.collect()} == {"edge_count": 3, "cycle_count": 2 + 3}
    merged, whole = (sorted(files.scan_edges(spark, data.out(f"{g}/edges")).collect()) for g in ("g2", "all"))
    assert merged == whole and len(whole) == 5
    with pytest.raises(ValueError):
        jobs.run_graph(spark, data, "2026-05-10", graph_path=data.out("g3"))


def test_the_graph_job_merges_into_the_graph_it_keeps(spark, data, edges):
    from suretygraph.sinks import parquet as sink

    table = sink.edge_table(data.out("graph_edges"))
    first = [("A", "B", 1, 1), ("B", "A", 1, 2), ("C", "C", 1, 3)]
    sink.publish_by_day(edges(*first), table)
    jobs.run_graph(spark, data)
    reader = files.scan_edges(spark, data.out("graph/edges"))
    sink.publish_by_day(edges(("A", "B", 7, 9), ("B", "C", 1, 9), ("C", "A", 1, 10)), table)
    counts = jobs.run_graph(spark, data, "2026-05-10")
    assert {r.measure: int(r.value) for r in counts.collect()} == {"edge_count": 3, "cycle_count": 2 + 3}
    assert reader.count() == 3  # as it was when the reader looked
    assert files.scan_edges(spark, data.out("graph/edges")).count() == 5
    listed = Published(data.out("graph/ring_paths"), schemas.RING_PATHS).scan(spark)
    assert sorted(r.path for r in listed.filter("cycle_length = 3").collect()) == ["A>B>C>A", "B>C>A>B", "C>A>B>C"]
    sink.publish_by_day(edges(("B", "B", 1, 1)), table)  # a late edge, outside the window
    jobs.run_graph(spark, data, "2026-05-10", listings=False)
    assert files.scan_edges(spark, data.out("graph/edges")).count() == 5
    jobs.run_graph(spark, data, "2026-05-10", listings=False, late_days=True)
    assert files.scan_edges(spark, data.out("graph/edges")).count() == 6


def test_command_line(spark, data, monkeypatch, capsys):
    from suretygraph import cli

    arguments = ["--transactions", data.transactions, "--free-accounts", data.free_accounts, "--vendors", data.vendors,
                 "--output", data.output, "--process-date", "2026-05-07"]
    monkeypatch.delenv("PII_SALT", raising=False)
    with pytest.raises(SystemExit):
        cli.main(["vendors", *arguments])
    monkeypatch.setenv("PII_SALT", "s")
    for job in ("vendors", "transactions", "graph"):
        cli.main([job, *arguments])
    assert "cycle_count" in capsys.readouterr().out
    log = data.out("log")
    spark.createDataFrame([("VEN_0", 1, 200, '{"domain": "a.example"}')], "vendor_id string, attempt int, status_code int, response_body string").write.parquet(log)
    lines = data.vendors.replace(".json", "_lines.json")
    with open(data.vendors) as array, open(lines, "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in json.load(array))
    cli.main(["all", *arguments, "--vendors", lines, "--vendor-lines", "--attempts", log, "--again", "2026-05-03", "--late-days",
              "--graph", data.out("graph2"), "--previous-graph", data.out("graph")])
    shown = capsys.readouterr().out
    assert "network_errors" in shown and "cycle_count" in shown
    assert files.scan_edges(spark, data.out("graph2/edges")).count() == files.scan_edges(spark, data.out("graph/edges")).count()
    assert files.scan_edges(spark, data.out("graph_edges")).agg({"guarantee_amount_usd": "sum"}).first()[0] > Decimal(0)
