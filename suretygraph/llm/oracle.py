"""DuckDB equivalents of the queries that SQL can express."""

from __future__ import annotations

from suretygraph.llm import secrets

#: Words between spaces and the controls 09 to 0D.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {}

ORACLE["op5_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k
  FROM d, LATERAL unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50
),
f AS (SELECT k, min(doc_id) AS least FROM s GROUP BY k),
r AS (SELECT s.doc_id, list(s.i) AS begins FROM s JOIN f ON s.k = f.k AND f.least < s.doc_id GROUP BY s.doc_id),
o AS (
  SELECT doc_id, list(DISTINCT j) AS gone
  FROM (SELECT doc_id, unnest(begins) AS i FROM r), LATERAL unnest(range(i, i + 50)) AS u(j) GROUP BY doc_id
),
x AS (
  SELECT d.doc_id, p, w[p] AS word FROM d, LATERAL unnest(range(1, len(w) + 1)) AS u(p)
),
g AS (SELECT doc_id, unnest(gone) AS p FROM o),
k AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
  FROM x ANTI JOIN g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

ORACLE["op8_minhash_dedup"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w
  FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS k
  FROM d
),
t AS (SELECT min(doc_id) AS doc_id, k, len(k) AS n FROM (SELECT doc_id, list_sort(k) AS k FROM s) WHERE len(k) > 0 GROUP BY k),
e AS (SELECT doc_id, n, md5(unnest(k)) AS g FROM t),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS x, doc_id AS c FROM t UNION SELECT l.b, r.c FROM r JOIN l ON r.x = l.a),
c AS (SELECT x, min(c) AS c FROM r GROUP BY x),
m AS (SELECT t.k, c.c FROM t JOIN c ON t.doc_id = c.x)
SELECT s.doc_id, len(s.k)::BIGINT AS n_shingles, coalesce(m.c, s.doc_id) AS component_id,
       coalesce(m.c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN m ON list_sort(s.k) = m.k
"""

_ALNUM = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op10_decontamination"] = rf"""
WITH b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
v AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS k, least(len(w), 13) AS n
  FROM b, LATERAL unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0
),
d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
n AS (SELECT DISTINCT n FROM v),
h AS (
  SELECT doc_id, i, n.n, array_to_string(w[i : i + n.n - 1], ' ') AS k
  FROM d, n, LATERAL unnest(range(1, len(w) - n.n + 2)) AS u(i) WHERE len(w) >= n.n
),
m AS (SELECT h.doc_id, h.i, h.n, v.item_id FROM h JOIN v ON h.k = v.k AND h.n = v.n),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM m), LATERAL unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
),
j AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN j ON d.doc_id = j.doc_id
"""

ORACLE["op3_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS k FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY k) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, k AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

ORACLE["op6_mixture"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, text, source, len({WORDS})::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS n, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source
),
t AS (SELECT sum(n) AS n FROM s),
r AS (
  SELECT 0 AS step, source, n, w, false AS is_full FROM s
  UNION ALL
  SELECT step + 1, source, n, w, is_full OR 3 * n <= level * w
  FROM (
    SELECT r.*, ((SELECT n FROM t) - sum(CASE WHEN is_full THEN 3 * n ELSE 0 END) OVER ())
                / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS level
    FROM r
  ) WHERE step < 200
),
l AS (
  SELECT source, n, w, is_full,
         ((SELECT n FROM t) - sum(CASE WHEN is_full THEN 3 * n ELSE 0 END) OVER ())::DOUBLE
         / sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS level
  FROM r WHERE step = 200
),
g AS (SELECT source, n, CASE WHEN is_full THEN 3.0::DOUBLE * n ELSE level * w END AS target FROM l),
c AS (
  SELECT d.*, g.n, target, CASE WHEN g.n > 0 THEN target / g.n ELSE 0 END AS rate,
         ('0x' || substr(md5('mixture:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 13))::BIGINT
         / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, n AS source_size, target,
       (least(floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM c
"""

_SYMBOLS = "[#*$%&|<>]"

ORACLE["op1_host_quality"] = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS k
  FROM d, LATERAL unnest(range(1, len(w) - 1)) AS u(i) WHERE len(w) >= 3
),
a AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM a, LATERAL unnest(range(i, i + 3)) AS u(p) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '{_SYMBOLS}'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d) d
  LEFT JOIN r ON d.doc_id = r.doc_id
),
f AS (
  SELECT *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > n_words,
             word_chars > 12 * n_words OR word_chars < 2 * n_words] AS bad FROM m
),
x AS (SELECT source, j, count(*) AS n, sum(bad[j]::INT) AS f FROM f, range(1, 6) AS u(j) WHERE source IS NOT NULL GROUP BY source, j),
p AS (SELECT j, sum(f) / sum(n) AS mean FROM x GROUP BY j),
v AS (SELECT x.j, mean, sum(n * (f / n - mean) * (f / n - mean)) / sum(n) AS var FROM x JOIN p ON x.j = p.j GROUP BY x.j, mean),
k AS (SELECT *, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 1), 10000) ELSE 10000 END AS strength FROM v),
h AS (SELECT source, bool_or((f + mean * strength) / (n + strength) > 0.6) AS rejected FROM x JOIN k ON x.j = k.j GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bad[1] OR bad[2] AS base_failed,
       NOT (bad[1] OR bad[2]) AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN h ON f.source = h.source
"""

ORACLE["op9_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         length(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>'))
         + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24 AS size
  FROM c
),
s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR i = n THEN upto END)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit, the lowest bit of each byte first."""
    bits = f"list_transform(range(0, length(bin({text}))), lambda k: substr(bin({text}), k - k % 8 + 8 - k % 8, 1)::BIGINT)"
    step = "xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce({bits}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


ORACLE["op13_importance_resampling"] = rf"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT {_ALNUM} AS w FROM benchmark),
f AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM d
),
x AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM b
),
k AS (SELECT g, {crc32("g")} % 10000 AS bucket FROM (SELECT g FROM f UNION SELECT g FROM x)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN k ON f.g = k.g GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM x JOIN k ON x.g = k.g GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM f)::DOUBLE AS all_s, (SELECT count(*) FROM x)::DOUBLE AS all_t),
a AS (
  SELECT r.bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (all_s + 10000) / ((coalesce(s, 0) + 1.0::DOUBLE) * (all_t + 10000))))::BIGINT AS gain
  FROM range(10000) r(bucket) CROSS JOIN n LEFT JOIN s ON s.bucket = r.bucket LEFT JOIN t ON t.bucket = r.bucket
),
m AS (SELECT doc_id, sum(gain)::BIGINT AS total, count(*)::BIGINT AS n FROM f JOIN k ON f.g = k.g JOIN a ON a.bucket = k.bucket GROUP BY doc_id),
o AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
         (coalesce(total, 0) - ((coalesce(total, 0) % greatest(coalesce(n, 0), 1)) + greatest(coalesce(n, 0), 1)) % greatest(coalesce(n, 0), 1))
         // greatest(coalesce(n, 0), 1) AS weight,
         ('0x' || substr(sha256('7:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN m ON d.doc_id = m.doc_id
),
q AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM o),
p AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM q WHERE n_words >= 20
)
SELECT q.doc_id, n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN place <= n * 25 // 100 THEN place END::BIGINT AS rank
FROM q LEFT JOIN p ON q.doc_id = p.doc_id
"""

ORACLE["op12_prefix_trie"] = rf"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, ''))::BIGINT AS chars,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id, {crc32("conv_id::VARCHAR")} % 6 AS h, list(x ORDER BY turn NULLS FIRST, x) AS x, list(chars ORDER BY turn NULLS FIRST, x) AS n
  FROM t GROUP BY conv_id
),
q AS (
  SELECT c.conv_id, list_concat(coalesce(b.x, [])[1 : c.h], c.x[c.h + 1 :]) AS x, list_concat(coalesce(b.n, [])[1 : c.h], c.n[c.h + 1 :]) AS n
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100
),
m AS (
  SELECT conv_id, d, len(x) AS size, md5(array_to_string(x[1 : d], ',')) AS k, md5(array_to_string(x[1 : d - 1], ',')) AS up,
         CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars
  FROM q, LATERAL unnest(range(0, len(x) + 1)) AS u(d)
),
v AS (
  SELECT d, k, CASE WHEN d > 0 THEN any_value(up) END AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = size), '')) AS ends_sha256
  FROM m GROUP BY d, k
),
w AS (SELECT d - 1 AS d, up, count(*) AS n FROM v WHERE d > 0 GROUP BY d, up),
y AS (SELECT v.*, coalesce(w.n, 0) AS n_children FROM v LEFT JOIN w ON v.d = w.d AND v.k = w.up),
s AS (
  SELECT m.d, m.k, sum(saved)::BIGINT AS saved_tokens, count_if(n_children = 0)::BIGINT AS n_leaves
  FROM y JOIN m ON m.conv_id = y.conv_id AND m.d <= y.d GROUP BY m.d, m.k
)
SELECT y.conv_id, y.d::BIGINT AS depth, p.conv_id AS parent_conv_id, y.n_convs::BIGINT AS n_convs, y.n_children::BIGINT AS n_children,
       n_leaves, saved_tokens, y.ends_sha256
FROM y JOIN s ON y.d = s.d AND y.k = s.k LEFT JOIN v p ON p.d = y.d - 1 AND p.k = y.up
"""


def _located(source: str, key: str, pattern: str) -> str:
    """All matches of a pattern in ``text``, with their places."""
    quoted = pattern.replace("'", "''")
    return rf"""SELECT {key}, s, b + a - length(s) AS b, b + a AS e FROM (
    SELECT {key}, ms[i] AS s, list_sum(list_transform(ms[1 : i], lambda x: length(x)))::BIGINT AS a,
           list_sum(list_transform(bs[1 : i], lambda x: length(x)))::BIGINT AS b
    FROM (SELECT {key}, regexp_extract_all(text, '{quoted}') AS ms, string_split_regex(text, '{quoted}') AS bs FROM {source}),
         LATERAL unnest(range(1, len(ms) + 1)) AS u(i))"""


def _windows(k: int, c: secrets.CharacterClass) -> str:
    """The ranges of high entropy of one class in the candidates."""
    table = str(secrets.n_log_n(c.width))
    counted = f"list_transform(list_distinct(string_split(w, '')), lambda x: {table}[{c.width} - length(replace(w, x, '')) + 1])"
    return rf"""SELECT doc_id, {k} AS kind, b + min(i) AS b, b + max(i) + {c.width} AS e FROM (
    SELECT *, sum(CASE WHEN i > before + {c.width} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, b ORDER BY i) AS island FROM (
      SELECT doc_id, b, i, lag(i, 1, i) OVER (PARTITION BY doc_id, b ORDER BY i) AS before
      FROM (SELECT doc_id, b, i, substr(s, i + 1, {c.width}) AS w FROM c, LATERAL unnest(range(0, length(s) - {c.width} + 1)) AS u(i))
      WHERE regexp_full_match(w, '{c.pattern}+') AND regexp_matches(w, '[0-9]') AND regexp_matches(w, '[^0-9]')
        AND list_sum({counted}) <= {secrets.largest_sum(c)}
    )) GROUP BY doc_id, b, island"""


_ALLOWED = "|".join(f"(?:{a})" for a in secrets.ALLOWED)
_KINDS = [*secrets.BASE, *(c.name for c in secrets.CLASSES)]
_ASSIGN_END = secrets.ASSIGN.replace("'", "''")

ORACLE["op11_secrets"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
a AS ({_located("d", "doc_id", secrets.ASSIGN)}),
k AS ({_located("d", "doc_id", secrets.ACCESS)}),
h AS ({_located("d", "doc_id", secrets.HEX)}),
n AS (
  SELECT doc_id, 0 AS kind, b, e FROM a WHERE length(regexp_extract(s, '{_ASSIGN_END}', 1)) >= 8
  UNION ALL SELECT doc_id, 1, b, e FROM k
  UNION ALL SELECT doc_id, 2, b, e FROM h
),
r AS ({_located("d", "doc_id", secrets.CANDIDATE + "{20,}")}),
c AS (SELECT * FROM r WHERE NOT regexp_matches(s, '{_ALLOWED}')),
w AS ({" UNION ALL ".join(_windows(k, c) for k, c in enumerate(secrets.CLASSES, len(secrets.BASE)))}),
x AS (
  SELECT * FROM n UNION ALL
  SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.doc_id = w.doc_id AND n.b <= w.b AND n.e >= w.e)
),
o AS (SELECT *, {str(_KINDS)}[kind + 1] || ':' || b || ':' || e AS t FROM x),
g AS (
  SELECT doc_id, count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex,
         coalesce(string_agg(t, ',' ORDER BY b, kind, e) FILTER (kind < 3), '') AS base, string_agg(t, ',' ORDER BY b, kind, e) AS spans
  FROM o GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
