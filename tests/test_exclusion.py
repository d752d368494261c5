import pytest
from conftest import ids, plan_of, tx

from suretygraph import schemas
from suretygraph.operators import exclusion


@pytest.fixture
def accounts(spark):
    def make(*pairs):
        return spark.createDataFrame([(a, None, None, b, None) for a, b in pairs], schemas.FREE_ACCOUNTS)

    return make


def test_qualifying_accounts_are_distinct(accounts):
    rows = accounts(
        ("A", "WELCOME_OFFER"), ("A", "PARTNER_ZERO_FEE"), ("B", "OTHER"), ("C", "FREE_PROMO_90D"), ("D", None)
    )
    assert ids(exclusion.qualifying_free_accounts(rows), "account_id") == ["A", "C"]


@pytest.mark.parametrize("limits", [{}, {"max_rows": 1}, {"max_bytes": 1}])
def test_either_end_excludes_and_nulls_stay(transactions, accounts, limits):
    listed = exclusion.exclusion_list(
        accounts(("A", "WELCOME_OFFER"), ("A", "FREE_PROMO_90D"), (None, "WELCOME_OFFER"), ("X", "OTHER")), **limits
    )
    rows = transactions(
        tx(id="source", source="A"), tx(id="target", source="X", target="A"), tx(id="neither", source="X"),
        tx(id="null source", source=None), tx(id="null target", source="X", target=None),
    )
    assert ids(exclusion.exclude_free_source(rows, listed)) == ["neither", "null source", "null target", "target"]
    clean = exclusion.exclude_free_accounts(rows, listed)
    assert ids(clean) == ["neither", "null source", "null target"]
    plan = plan_of(clean)
    joins = "SortMergeJoin" if limits else "BroadcastHashJoin"
    assert plan.count(joins) >= 2
    if not limits:
        assert "Exchange hashpartitioning" not in plan


def test_empty_list_excludes_nothing(transactions, accounts):
    listed = exclusion.exclusion_list(accounts())
    assert ids(exclusion.exclude_free_accounts(transactions(tx()), listed)) == ["T1"]
