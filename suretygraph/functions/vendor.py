"""Vendor rules, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from suretygraph.constants import DOMAIN_KEYWORDS, RETRY_STATUSES, UNKNOWN_DOMAIN
from suretygraph.schemas import LOOKUP_RESPONSE

SUCCESS = "SUCCESS"
FAILED = "FAILED"
NETWORK_ERROR = "NETWORK_ERROR"


def domain_for(
    company_name: Column,
    keywords: Sequence[tuple[str, str]] = DOMAIN_KEYWORDS,
    default: str = UNKNOWN_DOMAIN,
) -> Column:
    """Domain of the first keyword contained in the lower-cased name.

    The ordered list is a parameter of the job, so it becomes one CASE expression: no join, no shuffle.
    """
    name = F.lower(company_name)
    found = [F.when(F.contains(name, F.lit(word)), F.lit(domain)) for word, domain in keywords]
    return F.coalesce(*found, F.lit(default))


def attempt_class(status_code: Column) -> Column:
    """SUCCESS and FAILED end a vendor's lookup; the other classes are tried again."""
    kind = F.when(status_code.isNull(), NETWORK_ERROR).when(status_code == 200, SUCCESS)
    for code, name in RETRY_STATUSES.items():
        kind = kind.when(status_code == code, name)
    return kind.otherwise(FAILED)


def is_final(kind: Column) -> Column:
    return kind.isin(SUCCESS, FAILED)


def response_domain(body: Column) -> Column:
    """``domain`` of a JSON answer; null where it is missing or the text is not JSON."""
    return F.from_json(body, LOOKUP_RESPONSE).getField("domain")


def hash_tax_id(tax_id: Column, salt: str, null_text: str | None = None) -> Column:
    """Hex SHA-256 of salt and tax id. A null id gives null, or is hashed as ``null_text`` if given."""
    value = tax_id if null_text is None else F.coalesce(tax_id, F.lit(null_text))
    return F.sha2(F.concat(F.lit(salt), value), 256)


def enrichment_status(domain: Column) -> Column:
    return F.when(F.length(domain) > 0, SUCCESS).otherwise(FAILED)
