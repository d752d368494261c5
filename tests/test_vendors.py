import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from suretygraph import schemas
from suretygraph.constants import DOMAIN_KEYWORDS
from suretygraph.functions import vendor as rule
from suretygraph.operators import vendors
from suretygraph.operators.vendors import number_attempts


@pytest.fixture
def records(spark):
    def make(*rows):
        return spark.createDataFrame([(i, n, "CL", t, "lookup") for i, n, t in rows], schemas.VENDORS)

    return make


@pytest.fixture
def attempts(spark):
    """Attempts from vendor=[(status, body), ...], numbered in order."""

    def make(**logs):
        rows = [(v, i, s, b) for v, log in logs.items() for i, (s, b) in enumerate(log, 1)]
        return spark.createDataFrame(rows, "vendor_id string, attempt int, status_code int, response_body string")

    return make


@pytest.mark.parametrize(
    "name, domain",
    [
        ("NovaTech Solutions Division 100 S.A.", "novatech.cl"),
        ("AUSTRAL leasing", "australleasing.pe"),
        ("Austral Andina", "andinaseguros.pe"),
        ("Nobody", "unknown-company.com"),
        ("", "unknown-company.com"),
        (None, "unknown-company.com"),
    ],
)
def test_first_keyword_decides(records, name, domain):
    assert vendors.resolve_vendor_domain(records(("V", name, "1"))).first().domain == domain


def test_keywords_are_a_parameter(records):
    resolved = vendors.resolve_vendor_domain(records(("V", "Nobody", "1")), keywords=(("body", "b.example"),), default="x")
    assert resolved.first().domain == "b.example"
    assert len(DOMAIN_KEYWORDS) == 10


def test_tax_id_hash(records):
    rows = records(("A", "n", "96884102-K"), ("B", "n", None))
    hashed = {r.vendor_id: r.tax_id_sha256 for r in vendors.hashed_tax_ids(rows, salt="s").collect()}
    assert hashed == {"A": hashlib.sha256(b"s96884102-K").hexdigest(), "B": None}
    with_text = vendors.hashed_tax_ids(rows, salt="s", null_tax_id="None").collect()
    assert with_text[1].tax_id_sha256 == hashlib.sha256(b"sNone").hexdigest()


def test_classes_and_domains(spark):
    df = spark.createDataFrame(
        [(200, '{"domain": "a.example", "vendor_id": 1}'), (429, None), (503, ""), (None, None), (404, "{}"), (500, "no json"),
         (200, '{"domain": null}'), (200, "[1]")],
        "status_code int, response_body string",
    )
    rows = df.select(
        rule.attempt_class(F.col("status_code")).alias("c"), rule.response_domain(F.col("response_body")).alias("d")
    ).collect()
    assert [r.c for r in rows] == [
        "SUCCESS", "RATE_LIMITED", "UNAVAILABLE", "NETWORK_ERROR", "FAILED", "FAILED", "SUCCESS", "SUCCESS"
    ]
    assert [r.d for r in rows] == ["a.example"] + [None] * 7


def test_outcomes(attempts):
    good = (200, '{"domain": "a.example"}')
    outcomes = vendors.vendor_outcome(attempts(
        at_once=[good, (404, None)],
        late=[(429, None), (None, None), (503, None), (None, None), good],
        too_late=[(503, None)] * 5 + [good],
        refused=[(429, None), (404, None), good],
        network=[(None, None)] * 7,
        short=[(429, None)],
        no_domain=[(200, "{}")],
        bad_body=[(200, "oops")],
    ))
    found = {r.vendor_id: (r.outcome, r.domain, r.retries, r.network_errors) for r in outcomes.collect()}
    assert found == {
        "at_once": ("SUCCESS", "a.example", 0, 0),
        "late": ("SUCCESS", "a.example", 4, 2),
        "too_late": ("FAILED", None, 5, 0),
        "refused": ("FAILED", None, 1, 0),
        "network": ("FAILED", None, 5, 5),
        "short": ("FAILED", None, 1, 0),
        "no_domain": ("SUCCESS", None, 0, 0),
        "bad_body": ("SUCCESS", None, 0, 0),
    }
    assert tuple(vendors.enrichment_counters(outcomes).first()) == (4, 4, 16, 7)


def test_counters_of_nothing(attempts, spark):
    empty = vendors.vendor_outcome(attempts(a=[(200, "{}")]).limit(0))
    assert tuple(vendors.enrichment_counters(empty).first()) == (0, 0, 0, 0)


def test_numbering_follows_time_then_id(spark):
    at = [datetime(2026, 5, 1, 0, 0, s) for s in range(3)]
    log = spark.createDataFrame(
        [("V", at[2], 1, 1, None), ("V", at[0], 3, 2, None), ("V", at[0], 2, 3, None), ("W", at[1], 9, 4, None)],
        "vendor_id string, attempted_at timestamp, attempt_id long, status_code int, response_body string",
    )
    assert {(r.vendor_id, r.attempt, r.status_code) for r in number_attempts(log).collect()} == {
        ("V", 1, 3), ("V", 2, 2), ("V", 3, 1), ("W", 1, 4)
    }
    assert number_attempts(log, max_attempts=1).count() == 2


def test_output_record(records, attempts):
    outcomes = vendors.vendor_outcome(attempts(A=[(200, '{"domain": "a.example"}')], B=[(200, '{"domain": ""}')]))
    resolved = vendors.domains_from_outcomes(records(("A", "n", "1"), ("B", "n", "2"), ("C", "n", "3")), outcomes)
    rows = vendors.enriched_vendors(resolved, salt="s", run_date="2026-05-07T00:00:00", processed_at="2026-05-07 01:02:03")
    assert rows.columns == [f.name for f in schemas.ENRICHED_VENDORS]
    found = {r.vendor_id: (r.official_domain, r.enrichment_status) for r in rows.collect()}
    assert found == {"A": ("a.example", "SUCCESS"), "B": ("", "FAILED"), "C": (None, "FAILED")}
    first = rows.first()
    assert first.execution_date == "2026-05-07" and first.processed_at == "2026-05-07T01:02:03.000000"
    assert vendors.enriched_vendors(resolved, salt="s").first().execution_date is None
