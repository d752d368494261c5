"""Delivered files are taken once as they are: nothing lost, nothing twice."""

import os

import pytest
from conftest import ids

from suretygraph.plans import jobs
from suretygraph.schemas import TRANSACTIONS
from suretygraph.sources import files


class Deliveries:
    def __init__(self, root):
        self.root, self.store = str(root / "in"), str(root / "store")

    def write(self, day, name, *lines):
        os.makedirs(f"{self.root}/day={day}", exist_ok=True)
        with open(f"{self.root}/day={day}/{name}", "w") as out:
            out.write("\n".join([",".join(TRANSACTIONS.names), *lines]) + "\n")

    def take(self, spark, **options):
        return files.take_in(spark, self.root, self.store, rejected_path=f"{self.store}/rejected", **options)

    def taken(self, spark):
        return ids(files.scan_taken_in(spark, self.store))


def line(name, at="2026-05-06 10:00:00", amount="70"):
    return f"{name},ACC_900,ACC_901,{amount},1,APPROVED,{at},CL"


@pytest.fixture
def deliveries(tmp_path):
    return Deliveries(tmp_path)


def test_a_delivery_that_grows(spark, deliveries):
    assert deliveries.take(spark) == files.Taken()
    deliveries.write("2026-05-18", "a.csv", line("A"), "broken,ACC_1")
    assert deliveries.take(spark) == files.Taken(("2026-05-18",), (), 1, 2, 1)
    deliveries.write("2026-05-18", "b.csv", line("B"), line("N", amount="x"))
    deliveries.write("2026-05-19", "c.csv", line("C"))
    assert deliveries.take(spark) == files.Taken(("2026-05-18", "2026-05-19"), (), 2, 3, 1)
    assert deliveries.taken(spark) == ["A", "B", "C", "N", "broken"]
    assert sorted((str(r.delivery), r.line[:6]) for r in files.scan_rejected(spark, f"{deliveries.store}/rejected").collect()) == [
        ("2026-05-18", "N,ACC_"), ("2026-05-18", "broken")]
    before = files.intake_rows(deliveries.store).snapshot(spark)
    assert deliveries.take(spark) == files.Taken() and files.intake_rows(deliveries.store).snapshot(spark) == before


def test_files_that_change_go_or_come_in_the_place_of_others(spark, deliveries):
    deliveries.write("2026-05-18", "a.csv", line("A"))
    deliveries.write("2026-05-18", "b.csv", line("B"), "broken")
    deliveries.write("2026-05-20", "c.csv", line("C"))
    deliveries.take(spark)
    deliveries.write("2026-05-18", "a.csv", line("A2"), line("A3"))
    assert deliveries.take(spark).anew == ("2026-05-18",)
    assert deliveries.taken(spark) == ["A2", "A3", "B", "C", "broken"]
    os.remove(f"{deliveries.root}/day=2026-05-20/c.csv")
    assert deliveries.take(spark) == files.Taken()  # cleaned up
    assert "C" in deliveries.taken(spark)
    os.remove(f"{deliveries.root}/day=2026-05-18/b.csv")
    deliveries.write("2026-05-18", "b2.csv", line("B2"))
    assert deliveries.take(spark).anew == ("2026-05-18",)  # delivered again under another name
    assert deliveries.taken(spark) == ["A2", "A3", "B2", "C"]
    assert files.scan_rejected(spark, f"{deliveries.store}/rejected").count() == 0
    assert deliveries.take(spark, again=(d for d in ["2026-05-18"])).files == 2
    assert deliveries.taken(spark) == ["A2", "A3", "B2", "C"]


@pytest.mark.parametrize("dies_at", ["rows", "rejected", "files"])
def test_a_take_that_dies_is_taken_again(spark, deliveries, monkeypatch, dies_at):
    from suretygraph import published

    deliveries.write("2026-05-18", "a.csv", line("A"))
    deliveries.take(spark)
    deliveries.write("2026-05-18", "b.csv", line("B"), "broken")
    write = published.write_text

    def dies(spark, file, text):
        if f"/{dies_at}/" in file:
            raise RuntimeError("killed")
        write(spark, file, text)

    monkeypatch.setattr(published, "write_text", dies)
    with pytest.raises(RuntimeError):
        deliveries.take(spark)
    assert "A" in deliveries.taken(spark)
    monkeypatch.undo()
    deliveries.write("2026-05-18", "c.csv", line("C"))
    deliveries.take(spark)
    assert deliveries.taken(spark) == ["A", "B", "C", "broken"]
    assert files.scan_rejected(spark, f"{deliveries.store}/rejected").count() == 1
    assert deliveries.take(spark) == files.Taken()


def test_other_folders_are_no_deliveries(spark, deliveries):
    deliveries.write("tmp", "a.csv", line("X"))
    deliveries.write("2026-13-45", "a.csv", line("Y"))
    os.makedirs(f"{deliveries.root}/notes")
    assert deliveries.take(spark) == files.Taken()
    deliveries.write("2026-05-18", "a.csv", line("A"), line("U", at=""))
    deliveries.take(spark)
    assert deliveries.taken(spark) == ["A", "U"]
    assert ids(files.scan_taken_in(spark, deliveries.store, "2026-05-07")) == ["A"]
    assert files.scan_taken_in(spark, deliveries.store, "2026-06-30").count() == 0


@pytest.fixture
def paths(tmp_path, deliveries, spark):
    free = str(tmp_path / "free.csv")
    with open(free, "w") as out:
        out.write("account_id,account_name,client_segment,benefit_type,activation_date\nACC_100,p,SME,WELCOME_OFFER,2026-01-10\n")
    return jobs.Paths(deliveries.root, free, "", str(tmp_path / "out"))


def curated(spark, paths):
    return ids(files.scan_curated(spark, paths.out("transactions")))


def test_late_days_reach_every_table(spark, deliveries, paths):
    for day in range(1, 8):
        deliveries.write(f"2026-05-0{day}", "t.csv", line(f"T{day}", at=f"2026-05-0{day} 10:00:00"))
    jobs.run_transactions(spark, paths)
    deliveries.write("2026-05-18", "t.csv", line("LATE", at="2026-05-03 11:00:00"), line("T18", at="2026-05-18 10:00:00"))
    jobs.run_transactions(spark, paths, "2026-05-18")
    assert "LATE" not in curated(spark, paths) and "T18" in curated(spark, paths)  # the window's own days only
    jobs.run_transactions(spark, paths, "2026-05-18", late_days=True)
    assert curated(spark, paths) == sorted(["LATE", "T18", *(f"T{d}" for d in range(1, 8))])
    metrics = {str(r.transaction_day): r.total_transactions for r in files.scan_risk_metrics(spark, paths.out("risk_metrics")).collect()}
    assert metrics == {"2026-05-03": 2, "2026-05-18": 1}
    assert files.scan_edges(spark, paths.out("graph_edges")).count() == 9
    # Nothing came since: only the window is done. A replaced delivery takes its late row back.
    jobs.run_transactions(spark, paths, "2026-05-18", late_days=True)
    assert files.scan_risk_metrics(spark, paths.out("risk_metrics")).count() == 1
    deliveries.write("2026-05-18", "t.csv", line("T18b", at="2026-05-18 10:00:00"))
    jobs.run_transactions(spark, paths, "2026-05-20", late_days=True)
    assert curated(spark, paths) == sorted(["T18b", *(f"T{d}" for d in range(1, 8))])


def test_late_days_survive_a_run_that_died(spark, deliveries, paths, monkeypatch):
    deliveries.write("2026-05-01", "t.csv", line("T1", at="2026-05-01 10:00:00"))
    jobs.run_transactions(spark, paths)
    deliveries.write("2026-05-18", "t.csv", line("LATE", at="2026-05-02 10:00:00"))
    monkeypatch.setattr(jobs.sink, "publish_risk_metrics", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_transactions(spark, paths, "2026-05-18", late_days=True)
    monkeypatch.undo()
    jobs.run_transactions(spark, paths, "2026-05-19", late_days=True)
    assert curated(spark, paths) == ["LATE", "T1"] and files.scan_edges(spark, paths.out("graph_edges")).count() == 2


def test_counters_of_a_run(spark, deliveries, paths):
    deliveries.write(
        "2026-05-01", "t.csv", line("A"), line("A"), line("B", amount="0"), line("C", amount="x"), "broken",
        "D,ACC_100,B,5,1,APPROVED,2026-05-06 10:00:00,CL", "E,A,B,5,-1,DECLINED,2026-05-06 10:00:00,AR", "F,A,B,5,1,DECLINED,2026-05-06 10:00:00,CL",
        ",A,B,5,1,APPROVED,2026-05-06 10:00:00,CL")
    counts = jobs.run_transactions(spark, paths).first().asDict()
    assert counts == {
        "files_taken": 1, "lines_taken": 9, "lines_rejected": 2, "rows_read": 9, "without_id": 1, "duplicates": 1, "ids": 7,
        "bad_amount": 3, "bad_fee": 2, "bad_country": 2, "valid": 3, "not_approved": 1, "approved": 2, "promotional": 1, "written": 1}
    assert files.scan_taken_in(spark, paths.out("intake")).count() == 9
    again = jobs.run_transactions(spark, paths, "2026-05-30").first().asDict()
    assert set(again.values()) == {0}
