from datetime import date, datetime

import pytest
from conftest import tx

from suretygraph.operators import risk


@pytest.mark.parametrize(
    "amount, fee, expected",
    [
        ("50000.00", "1.00", (False, False, 0.0, "NORMAL")),
        ("50000.01", "1000.00", (True, False, 2.0, "HIGH")),
        ("200000.00", "1.00", (True, False, 0.0, "HIGH")),
        ("200000.01", "7000.00", (True, True, 3.5, "CRITICAL")),
        ("0.00", "1.00", (False, False, None, "NORMAL")),
        (None, "1.00", (False, False, None, "NORMAL")),
        ("3.00", None, (False, False, None, "NORMAL")),
        ("800.00", "1.00", (False, False, 0.13, "NORMAL")),  # 0.125 goes up
        ("3.00", "1.00", (False, False, 33.33, "NORMAL")),
    ],
)
def test_scores(transactions, amount, fee, expected):
    row = risk.enrich_transactions(transactions(tx(amount=amount, fee=fee))).first()
    assert (
        row.high_risk_transaction, row.very_high_risk_transaction, row.fee_percentage, row.risk_category
    ) == expected


def test_processed_at_can_be_given(transactions):
    row = risk.enrich_transactions(transactions(tx()), processed_at="2026-05-07 01:02:03").first()
    assert row.processed_at == datetime(2026, 5, 7, 1, 2, 3)
    assert risk.enrich_transactions(transactions(tx())).first().processed_at is not None


def test_daily_metrics_group_the_null_day(transactions):
    rows = transactions(
        tx(amount="60000.00"), tx(amount="40000.00"), tx(amount="10.10", at=None), tx(at="2026-05-02 00:00:00", amount="0.30")
    )
    metrics = {tuple(r) for r in risk.daily_risk_metrics(risk.enrich_transactions(rows)).collect()}
    assert metrics == {
        (date(2026, 5, 1), 2, 100000.0, 50000.0, 1), (None, 1, 10.1, 10.1, 0), (date(2026, 5, 2), 1, 0.3, 0.3, 0)
    }


def test_high_volume_means_more_than_ten(transactions):
    rows = [tx(id=f"A{i}", source="A", amount="0.10") for i in range(11)]
    rows += [tx(id=f"B{i}", source="B") for i in range(10)]
    found = risk.high_volume_accounts(transactions(*rows)).collect()
    assert [tuple(r) for r in found] == [("A", 11, 1.1)]
