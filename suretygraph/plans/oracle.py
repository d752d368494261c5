"""DuckDB SQL that gives the same rows as the registered queries, written on its own.

The SQL follows the definitions literally (self-joins for rings, every path unrolled), so that it checks
the aggregated forms the Spark side uses.
"""

from __future__ import annotations

STAGES = """
WITH transactions AS (
  SELECT
    CASE WHEN l_quantity = 5 THEN NULL ELSE 'TX_' || l_orderkey || '_' || l_linenumber END AS transaction_id,
    'ACC_' || o_custkey AS source_account_id,
    'ACC_' || l_partkey AS target_account_id,
    CAST(CASE WHEN l_quantity = 1 THEN NULL
              WHEN l_quantity = 2 THEN 0
              WHEN l_quantity = 3 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
              WHEN l_quantity >= 45 THEN 5 * CAST(l_extendedprice AS DECIMAL(18,2))
              ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS guarantee_amount_usd,
    CASE WHEN l_quantity = 4 THEN NULL
         WHEN l_quantity = 6 THEN CAST(-1 AS DECIMAL(18,2))
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2))
    END AS fee_amount_usd,
    CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'O' THEN 'PENDING_RISK_AUDIT' ELSE 'DECLINED' END AS status,
    o_orderdate AS "timestamp",
    CASE c_nationkey % 6 WHEN 0 THEN 'CL' WHEN 1 THEN 'PE' WHEN 2 THEN 'MX' WHEN 3 THEN 'BR' WHEN 4 THEN 'AR' END
      AS country_code,
    CAST(o_orderdate AS DATE) AS transaction_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
free_accounts AS (
  SELECT 'ACC_' || c_custkey AS account_id, c_name AS account_name, c_mktsegment AS client_segment,
    CASE c_custkey % 20 WHEN 0 THEN 'FREE_PROMO_90D' WHEN 1 THEN 'PARTNER_ZERO_FEE' WHEN 2 THEN 'WELCOME_OFFER'
                        ELSE 'OTHER_BENEFIT' END AS benefit_type,
    DATE '2026-01-01' AS activation_date
  FROM customer WHERE c_custkey % 20 < 4
),
vendors AS (
  SELECT 'VEN_' || s_suppkey AS vendor_id,
    CASE s_suppkey % 6 WHEN 0 THEN 'Delta Trading' WHEN 1 THEN 'Norte Holding' WHEN 2 THEN 'Norte Delta Group'
                       WHEN 3 THEN 'Lumen Works' WHEN 4 THEN 'Quartz Corp' ELSE 'DELTA Marine' END
      || ' Division ' || s_suppkey AS legal_name,
    CASE s_nationkey % 4 WHEN 0 THEN 'CL' WHEN 1 THEN 'PE' WHEN 2 THEN 'MX' ELSE 'BR' END AS country,
    'T-' || (s_suppkey * 7919) AS tax_id_pii,
    'lookup/' || s_suppkey AS search_api_endpoint
  FROM supplier
),
keywords(priority, keyword, domain) AS (
  VALUES (1, 'delta', 'delta.example'), (2, 'norte', 'norte.example'), (3, 'lumen', 'lumen.example')
),
resolved AS (
  SELECT v.*, coalesce((SELECT arg_min(k.domain, k.priority) FROM keywords k
                        WHERE contains(lower(v.legal_name), k.keyword)), 'unknown-company.com') AS domain
  FROM vendors v
),
attempts AS (
  SELECT 'VEN_' || user_id AS vendor_id, event_id AS attempt_id,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt,
    CASE event_type WHEN 'click' THEN 200 WHEN 'signup' THEN 429 WHEN 'view' THEN 503 WHEN 'purchase' THEN 404 END
      AS status_code,
    CASE WHEN event_type = 'click' THEN
      CASE WHEN value < 3 THEN '{}' ELSE '{"domain": "d' || user_id || '.example"}' END END AS response_body
  FROM events
),
classes AS (
  SELECT *,
    CASE WHEN status_code IS NULL THEN 'NETWORK_ERROR' WHEN status_code = 200 THEN 'SUCCESS'
         WHEN status_code = 429 THEN 'RATE_LIMITED' WHEN status_code = 503 THEN 'UNAVAILABLE' ELSE 'FAILED' END
      AS attempt_class,
    json_extract_string(response_body, '$.domain') AS domain
  FROM attempts
),
deciding AS (
  SELECT vendor_id, min(attempt) AS attempt FROM classes
  WHERE attempt <= 5 AND attempt_class IN ('SUCCESS', 'FAILED') GROUP BY vendor_id
),
outcomes AS (
  SELECT c.vendor_id,
    CASE WHEN count(*) FILTER (WHERE c.attempt_class = 'SUCCESS') > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS outcome,
    max(c.domain) FILTER (WHERE c.attempt_class = 'SUCCESS') AS domain,
    count(*) FILTER (WHERE c.attempt_class NOT IN ('SUCCESS', 'FAILED')) AS retries,
    count(*) FILTER (WHERE c.attempt_class = 'NETWORK_ERROR') AS network_errors
  FROM classes c LEFT JOIN deciding d ON c.vendor_id = d.vendor_id
  WHERE c.attempt <= coalesce(d.attempt, 5)
  GROUP BY c.vendor_id
),
dedup AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
        "timestamp" NULLS LAST, guarantee_amount_usd NULLS LAST, fee_amount_usd NULLS LAST,
        source_account_id NULLS LAST, target_account_id NULLS LAST, status NULLS LAST, country_code NULLS LAST) AS r
    FROM transactions WHERE transaction_id IS NOT NULL) WHERE r = 1
),
valid AS (
  SELECT * FROM dedup
  WHERE guarantee_amount_usd > 0 AND fee_amount_usd >= 0 AND country_code IN ('CL', 'PE', 'MX', 'BR')
),
approved AS (SELECT * FROM valid WHERE status = 'APPROVED'),
promotional AS (
  SELECT DISTINCT account_id FROM free_accounts
  WHERE benefit_type IN ('FREE_PROMO_90D', 'PARTNER_ZERO_FEE', 'WELCOME_OFFER')
),
clean_source AS (
  SELECT * FROM approved a WHERE NOT EXISTS (SELECT 1 FROM promotional p WHERE p.account_id = a.source_account_id)
),
clean AS (
  SELECT * FROM clean_source a WHERE NOT EXISTS (SELECT 1 FROM promotional p WHERE p.account_id = a.target_account_id)
),
enriched AS (
  SELECT *,
    guarantee_amount_usd > 50000 AS high_risk_transaction,
    guarantee_amount_usd > 200000 AS very_high_risk_transaction,
    ((CAST(fee_amount_usd * 100 AS HUGEINT) * 20000 + CAST(guarantee_amount_usd * 100 AS HUGEINT))
      // (2 * CAST(guarantee_amount_usd * 100 AS HUGEINT))) / 100.0::DOUBLE AS fee_percentage,
    CASE WHEN guarantee_amount_usd > 200000 THEN 'CRITICAL' WHEN guarantee_amount_usd > 50000 THEN 'HIGH'
         ELSE 'NORMAL' END AS risk_category
  FROM clean
),
metrics AS (
  SELECT transaction_day, count(*) AS total_transactions,
    CAST(sum(guarantee_amount_usd) AS DOUBLE) AS total_guarantee_amount,
    CAST(sum(guarantee_amount_usd) AS DOUBLE) / count(*) AS avg_transaction_amount,
    CAST(sum(CASE WHEN high_risk_transaction THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_transactions
  FROM enriched GROUP BY transaction_day
),
high_volume AS (
  SELECT source_account_id, count(*) AS transaction_count, CAST(sum(guarantee_amount_usd) AS DOUBLE) AS total_amount
  FROM enriched GROUP BY source_account_id HAVING count(*) > 10
)
"""

# The edge table the ring queries run on, chosen per query: which transactions, and one edge per pair or all.
EDGES = """,
base_edges AS (
  SELECT row_number() OVER () AS eid, source_account_id AS src, target_account_id AS tgt,
         guarantee_amount_usd AS amount, transaction_day AS day
  FROM {transactions}
),
ranked_edges AS (
  SELECT *, row_number() OVER (PARTITION BY src, tgt ORDER BY day DESC, amount DESC) AS newest FROM base_edges
),
e AS MATERIALIZED (SELECT * FROM ranked_edges WHERE {kept}),
paths AS MATERIALIZED (
  SELECT src AS a, src || '>' || tgt AS path, 1 AS cycle_length, [eid] AS eids FROM e WHERE src = tgt
  UNION ALL
  SELECT x.src, x.src || '>' || y.src || '>' || x.src, 2, [x.eid, y.eid]
  FROM e x JOIN e y ON x.tgt = y.src AND y.tgt = x.src AND x.eid <> y.eid
  UNION ALL
  SELECT x.src, x.src || '>' || y.src || '>' || z.src || '>' || x.src, 3, [x.eid, y.eid, z.eid]
  FROM e x JOIN e y ON x.tgt = y.src AND x.eid <> y.eid
           JOIN e z ON z.src = y.tgt AND z.tgt = x.src AND z.eid <> x.eid AND z.eid <> y.eid
),
steps AS (
  SELECT a, path, cycle_length, eids, unnest(eids) AS eid, generate_subscripts(eids, 1) AS i FROM paths
),
by_day AS (
  SELECT a AS account, e.day, sum(e.amount) AS total
  FROM steps JOIN e ON steps.eid = e.eid WHERE cycle_length BETWEEN 2 AND 3 GROUP BY a, e.day
)
"""


def _edges(select: str, transactions: str = "clean", temporal: bool = False) -> str:
    return EDGES.format(transactions=transactions, kept="true" if temporal else "newest = 1") + select


_FOLDED = """(
    SELECT 'F_' || l_orderkey % fold AS source_account_id,
           'F_' || (l_orderkey % fold + l_partkey % 5 - 2 + fold) % fold AS target_account_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS guarantee_amount_usd,
           DATE '1998-01-01' + CAST(l_quantity AS INTEGER) AS transaction_day
    FROM lineitem, (SELECT greatest(40, count(*) // 15) AS fold FROM lineitem)
    )"""


def _folded(select: str) -> str:
    """The same question to the edges of few accounts, in both modes."""
    return " UNION ALL ".join(
        f"SELECT *, '{mode}' AS mode FROM (WITH none AS (SELECT 1) {_edges(select, _FOLDED, mode == 'temporal')})"
        for mode in ("latest", "temporal"))


_TX = """transaction_id, source_account_id, target_account_id, CAST(guarantee_amount_usd AS DOUBLE) AS guarantee_amount_usd,
CAST(fee_amount_usd AS DOUBLE) AS fee_amount_usd, status, "timestamp", country_code, transaction_day"""
_SCORES = "high_risk_transaction, very_high_risk_transaction, fee_percentage, risk_category"
_EDGE = """source_account_id, target_account_id, CAST(guarantee_amount_usd AS DOUBLE) AS guarantee_amount_usd, transaction_day"""
_LATEST = """SELECT src AS source_account_id, tgt AS target_account_id, CAST(amount AS DOUBLE) AS guarantee_amount_usd,
day AS transaction_day FROM e"""
_PATHS = """SELECT a AS account, cycle_length, path, count(*) AS path_count FROM paths
WHERE cycle_length BETWEEN {} AND {} GROUP BY a, cycle_length, path"""
_COUNT = "SELECT count(*) AS cycle_count FROM paths WHERE cycle_length BETWEEN {} AND 3"
_BY_DAY = "SELECT account, day, CAST(total AS DOUBLE) AS total_amount FROM by_day"
_CHANGE = """SELECT account, day, CAST(total AS DOUBLE) AS total_amount,
CAST(previous AS DOUBLE) AS previous_amount, CAST(total - previous AS DOUBLE) AS change,
CAST(total - previous AS DOUBLE) / nullif(CAST(previous AS DOUBLE), 0) AS change_ratio
FROM (SELECT *, lag(total) OVER (PARTITION BY account ORDER BY day) AS previous FROM by_day)"""
_ENRICHED = """SELECT v.vendor_id, v.legal_name, v.country, d.domain AS official_domain,
sha256('benchmark-salt' || v.tax_id_pii) AS tax_id_sha256,
CASE WHEN length(d.domain) > 0 THEN 'SUCCESS' ELSE 'FAILED' END AS enrichment_status,
'1998-06-30' AS execution_date FROM vendors v LEFT JOIN {} d ON v.vendor_id = d.vendor_id"""

_OUTPUTS = """SELECT 'transactions' AS output, count(*) AS n_rows, coalesce(CAST(sum(guarantee_amount_usd) AS DOUBLE), 0) AS amount FROM enriched
UNION ALL SELECT 'risk_metrics', count(*), coalesce(CAST(sum(CAST(total_guarantee_amount AS DECIMAL(20,2))) AS DOUBLE), 0) FROM metrics
UNION ALL SELECT 'high_risk_accounts', count(*), coalesce(CAST(sum(CAST(total_amount AS DECIMAL(20,2))) AS DOUBLE), 0) FROM high_volume
UNION ALL SELECT 'graph_edges', count(*), coalesce(CAST(sum(guarantee_amount_usd) AS DOUBLE), 0) FROM clean
UNION ALL SELECT 'rejected_lines', 0, 0.0::DOUBLE"""

_SELECTS = {
    "transaction_day": f"SELECT {_TX} FROM transactions",
    "incremental_window":
        f"SELECT {_TX} FROM transactions WHERE transaction_day BETWEEN DATE '1998-06-24' AND DATE '1998-06-30'",
    "dedup_transactions": f"SELECT {_TX} FROM dedup",
    "validate_data_quality": f"SELECT {_TX} FROM valid",
    "approved_transactions": f"SELECT {_TX} FROM approved",
    "qualifying_free_accounts": "SELECT account_id FROM promotional",
    "exclude_free_source": f"SELECT {_TX} FROM clean_source",
    "exclude_free_accounts": f"SELECT {_TX} FROM clean",
    "enrich_transactions": f"SELECT {_TX}, {_SCORES}, '1998-07-01 12:30:00' AS processed_at FROM enriched",
    "daily_risk_metrics": "SELECT * FROM metrics",
    "high_volume_accounts": "SELECT * FROM high_volume",
    "graph_edges": f"SELECT {_EDGE} FROM clean",
    "graph_edges_export": """SELECT source_account_id AS src, target_account_id AS tgt,
        CAST(guarantee_amount_usd AS DOUBLE) AS amount, CAST(transaction_day AS VARCHAR) AS day FROM clean""",
    "edge_count": "SELECT count(*) AS edge_count FROM clean",
    "graph_nodes": "SELECT source_account_id AS id FROM clean UNION SELECT target_account_id FROM clean",
    "latest_edges": _edges(_LATEST),
    "upsert_edges": """SELECT source_account_id, target_account_id, CAST(amount AS DOUBLE) AS guarantee_amount_usd, transaction_day
        FROM (
          SELECT *, row_number() OVER (PARTITION BY source_account_id, target_account_id
                                       ORDER BY transaction_day DESC, is_new DESC, amount DESC) AS r
          FROM (
            SELECT source_account_id, target_account_id, guarantee_amount_usd AS amount, transaction_day, 0 AS is_new
            FROM clean WHERE transaction_day <= DATE '1998-06-30'
            UNION ALL
            SELECT source_account_id, target_account_id,
                   CAST((CAST(guarantee_amount_usd * 100 AS HUGEINT) + 1) // 2 / 100.0 AS DECIMAL(18,2)), transaction_day, 1
            FROM clean WHERE transaction_day >= DATE '1996-01-01'
          )
        ) WHERE r = 1""",
    "rings_len2": _edges(_PATHS.format(2, 2)),
    "rings_len3": _edges(_PATHS.format(3, 3)),
    "cycle_count": _edges(_COUNT.format(2)),
    "cycle_count_before_exclusion": _edges(_COUNT.format(2), transactions="approved"),
    "cycle_count_temporal": _edges(_COUNT.format(1), temporal=True),
    "cycle_paths": _edges("""SELECT s.a AS account, s.cycle_length, s.path,
        string_agg(CAST(e.day AS VARCHAR), '>' ORDER BY s.i) AS days,
        string_agg(CAST(e.amount AS VARCHAR), '>' ORDER BY s.i) AS amounts
        FROM steps s JOIN e ON s.eid = e.eid GROUP BY s.a, s.cycle_length, s.path, s.eids"""),
    "cycle_paths_temporal": _edges(_PATHS.format(1, 3), temporal=True),
    "cycle_amounts_by_day": _edges(_BY_DAY),
    "cycle_amounts_by_day_temporal": _edges(_BY_DAY, temporal=True),
    "cycle_amounts_before_exclusion": _edges(_BY_DAY, transactions="approved", temporal=True),
    "cycle_amount_change": _edges(_CHANGE, temporal=True),
    "resolve_vendor_domain": "SELECT vendor_id, legal_name, domain FROM resolved",
    "hash_tax_id": "SELECT vendor_id, sha256('benchmark-salt' || tax_id_pii) AS tax_id_sha256 FROM vendors",
    "enriched_vendors": _ENRICHED.format("resolved"),
    "enriched_vendors_from_attempts": _ENRICHED.format("outcomes"),
    "attempt_class": "SELECT vendor_id, attempt_id, status_code, attempt_class FROM classes",
    "response_domain": "SELECT vendor_id, attempt_id, domain FROM classes",
    "vendor_outcome": "SELECT * FROM outcomes",
    "enrichment_counters": """SELECT count(*) FILTER (WHERE outcome = 'SUCCESS') AS success,
        count(*) FILTER (WHERE outcome = 'FAILED') AS failed,
        CAST(sum(retries) AS BIGINT) AS retries, CAST(sum(network_errors) AS BIGINT) AS network_errors FROM outcomes""",
    "scan_transactions": f"SELECT {_TX} FROM transactions",
    "scan_free_accounts": "SELECT * FROM free_accounts",
    "scan_vendors": "SELECT * FROM vendors",
    "scan_edges": f"SELECT {_EDGE} FROM clean WHERE transaction_day BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'",
    "save_curated": f"SELECT {_TX}, {_SCORES} FROM enriched",
    "save_risk_metrics": "SELECT * FROM metrics",
    "save_high_volume": "SELECT * FROM high_volume",
    "save_edges": f"SELECT {_EDGE} FROM clean",
    "save_edges_again": """SELECT source_account_id, target_account_id, transaction_day,
        CAST(guarantee_amount_usd + CASE WHEN transaction_day >= DATE '1996-01-01' THEN 1 ELSE 0 END AS DOUBLE)
          AS guarantee_amount_usd FROM clean""",
    "save_vendors": _ENRICHED.format("resolved"),
    "save_vendors_json": _ENRICHED.format("outcomes"),
    "run_transactions": _OUTPUTS,
    "run_transactions_all_days": _OUTPUTS,
    "run_vendors": _ENRICHED.format("outcomes"),
    "run_graph": _edges("""SELECT 'edge_count' AS measure, count(*) AS value FROM clean
        WHERE transaction_day BETWEEN DATE '1998-06-24' AND DATE '1998-06-30'
        UNION ALL SELECT 'cycle_count', count(*) FROM paths WHERE cycle_length BETWEEN 2 AND 3""",
        transactions="""(SELECT * FROM clean WHERE transaction_day <= DATE '1998-06-30')"""),
    "run_all": _edges("""SELECT 'edge_count' AS measure, count(*) AS value FROM clean
        UNION ALL SELECT 'cycle_count', count(*) FROM paths WHERE cycle_length BETWEEN 2 AND 3
        UNION ALL SELECT 'success', count(*) FROM outcomes WHERE outcome = 'SUCCESS'
        UNION ALL SELECT 'failed', count(*) FROM outcomes WHERE outcome = 'FAILED'
        UNION ALL SELECT 'retries', CAST(sum(retries) AS BIGINT) FROM outcomes
        UNION ALL SELECT 'network_errors', CAST(sum(network_errors) AS BIGINT) FROM outcomes"""),
}

_SPANS = (("1998-01-01", "1998-01-25"), ("1998-01-15", "1998-02-05"), ("1998-02-01", "1998-02-28"))


def _span(k: int) -> str:
    return f"BETWEEN DATE '{_SPANS[k][0]}' AND DATE '{_SPANS[k][1]}'"


def _state(first: str, last: str, select: str, temporal: bool = False) -> str:
    """A question to the folded edges of some days."""
    some = f"(SELECT * FROM {_FOLDED} WHERE transaction_day BETWEEN DATE '{first}' AND DATE '{last}')"
    return f"(WITH none AS (SELECT 1) {_edges(select, some, temporal)})"


# Each span comes with other amounts; a later one wins on equal days.
_MERGED = "SELECT source_account_id, target_account_id, amount, transaction_day FROM (SELECT *, row_number() OVER (" \
    "PARTITION BY source_account_id, target_account_id ORDER BY transaction_day DESC, step DESC, amount DESC) AS r FROM (" \
    + " UNION ALL ".join(
        f"SELECT source_account_id, target_account_id, guarantee_amount_usd + {k} AS amount, transaction_day, {k} AS step "
        f"FROM {_FOLDED} WHERE transaction_day {_span(k)}" for k in range(3)) + ")) WHERE r = 1"

_MERGE_SELECTS = {
    "cycle_count_change": " UNION ALL ".join(
        f"SELECT (SELECT cycle_count FROM {_state(_SPANS[1][0], '1999-01-01', _COUNT.format(1), temporal)})"
        f" - (SELECT cycle_count FROM {_state('1990-01-01', _SPANS[0][1], _COUNT.format(1), temporal)}) AS cycle_count_change, '{mode}' AS mode"
        for mode, temporal in (("latest", False), ("temporal", True))),
    "merged_graph_edges":
        f"SELECT source_account_id, target_account_id, CAST(amount AS DOUBLE) AS guarantee_amount_usd, transaction_day FROM ({_MERGED})",
    "merged_graph_nodes": f"SELECT source_account_id AS id FROM ({_MERGED}) UNION SELECT target_account_id FROM ({_MERGED})",
    "merged_graph_counts": " UNION ALL ".join(
        f"SELECT {k}::BIGINT AS step, cycle_count FROM {_state('1998-01-01', _SPANS[k][1], _COUNT.format(2))}" for k in range(3)),
    "run_graph_edges": f"SELECT * FROM (WITH none AS (SELECT 1) {_edges(_LATEST, _FOLDED)})",
    "run_graph_ring_paths": f"SELECT * FROM (WITH none AS (SELECT 1) {_edges(_PATHS.format(1, 3), _FOLDED)})",
    "run_graph_ring_changes": f"SELECT * FROM (WITH none AS (SELECT 1) {_edges(_CHANGE, _FOLDED)})",
}

_SELECTS |= {
    "merged_outcomes": "SELECT * FROM outcomes",
    "take_in_grown": f"SELECT {_TX} FROM transactions",
    "take_in_replaced": f"""SELECT {_TX} FROM (SELECT * REPLACE (CAST(guarantee_amount_usd +
        CASE WHEN transaction_day >= DATE '1996-01-01' THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS guarantee_amount_usd) FROM transactions)""",
    "rejected_by_delivery": """SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS delivery, count(*) AS n_lines
        FROM transactions WHERE fee_amount_usd < 0 GROUP BY delivery""",
    "scan_vendors_array": "SELECT * FROM vendors",
    "run_transactions_late": f"SELECT {_TX}, {_SCORES} FROM enriched",
    "transaction_counters": """SELECT (SELECT count(*) FROM transactions) AS lines_taken, 0::BIGINT AS lines_rejected,
        (SELECT count(*) FROM transactions) AS rows_read, (SELECT count(*) FROM transactions WHERE transaction_id IS NULL) AS without_id,
        (SELECT count(transaction_id) FROM transactions) - count(*) AS duplicates, count(*) AS ids,
        count(*) FILTER (NOT coalesce(guarantee_amount_usd > 0, false)) AS bad_amount,
        count(*) FILTER (NOT coalesce(fee_amount_usd >= 0, false)) AS bad_fee,
        count(*) FILTER (NOT coalesce(country_code IN ('CL', 'PE', 'MX', 'BR'), false)) AS bad_country,
        (SELECT count(*) FROM valid) AS valid, (SELECT count(*) FROM valid) - (SELECT count(*) FROM approved) AS not_approved,
        (SELECT count(*) FROM approved) AS approved, (SELECT count(*) FROM approved) - (SELECT count(*) FROM clean) AS promotional,
        (SELECT count(*) FROM clean) AS written FROM dedup""",
}

# The job takes its window before anything else, so duplicates outside of it play no part.
_ALL_DAYS = "JOIN customer ON o_custkey = c_custkey"
_WINDOW = _ALL_DAYS + " WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-24' AND DATE '1998-06-30'"

_FOLDED_SELECTS = {
    "folded_cycle_counts": _folded(_COUNT.format(1)),
    "folded_cycle_paths": _folded(_PATHS.format(1, 3)),
    "folded_cycle_amount_change": _folded(_CHANGE),
}

ORACLE = {
    name: (STAGES.replace(_ALL_DAYS, _WINDOW) if name in ("run_transactions", "run_all") else STAGES) + select
    for name, select in _SELECTS.items()
} | _FOLDED_SELECTS | _MERGE_SELECTS
