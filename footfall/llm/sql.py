"""The same results in DuckDB's SQL, where SQL can say them."""

from __future__ import annotations

from footfall.llm.chat import CONTROLS
from footfall.llm.exact_search import SCALE as SCALE_SEARCH
from footfall.llm.queries import ODD_CHAT, ODD_TEXT
from footfall.llm.vector_codes import SCALE as SCALE_CODES

WORD = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM h)
SELECT page_id, CAST(payload_bytes AS bigint) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS bigint), 5) AS bigint)
      >> CAST(15 - 5 * (i % 4) AS integer)) & 31 AS bigint) + 1, 1)
    for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

OP10 = f"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS bigint) AS size
  FROM documents
),
s AS (SELECT source, CAST(sum(size) AS bigint) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0 * source_size AS cap, CAST([5, 2, 1][CAST(1 + (row_number() OVER (
      ORDER BY source IS NULL, encode(source)) - 1) % 3 AS bigint)] AS double) AS weight
  FROM s
),
o AS (
  SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM w
),
r AS (SELECT CAST(max(rate) AS double) AS rate FROM o WHERE weight * rate < cap),
t AS (
  SELECT source, source_size, CAST(least(cap, weight * r.rate) AS double) AS target
  FROM w, r
),
q AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
    md5('7:' || coalesce(CAST(doc_id AS varchar), '-') || ':' || size) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM q
)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN size > 0
    AND ahead + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS bigint) AS taken
FROM c
"""

OP3 = f"""
WITH b AS (
  SELECT CAST(item_id AS varchar) AS item,
    regexp_extract_all({_lower("text")}, '{ALPHANUMERIC}') AS words
  FROM benchmark WHERE text IS NOT NULL
),
wb AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
    array_to_string(words[i : i + 9], ' ') AS passage
  FROM (SELECT item, words, unnest(range(1, CAST(greatest(len(words) - 8, 2) AS bigint))) AS i
    FROM b WHERE len(words) > 0) x
),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({_lower("text")}, '{ALPHANUMERIC}'), []) AS words
  FROM documents
),
m AS (
  SELECT DISTINCT r, i, wb.size, item
  FROM (SELECT r, i, z.size, array_to_string(words[i : i + z.size - 1], ' ') AS passage
    FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM d) e,
      (SELECT DISTINCT size FROM wb) z
    WHERE i + z.size - 1 <= len(words)) g
  JOIN wb USING (passage, size)
),
h AS (
  SELECT r, count(DISTINCT w) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS w FROM (SELECT DISTINCT r, i, size FROM m) u) v
  GROUP BY r
),
n AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM m) u GROUP BY r
)
SELECT doc_id, CAST(len(words) AS bigint) AS n_words, CAST(coalesce(n_hit, 0) AS bigint) AS n_hit,
  CAST(coalesce(n_items, 0) AS bigint) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""

_CONTROL = "|".join(CONTROLS)
OP9 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({ODD_CHAT}, 0, 'user', '{ODD_TEXT}'), ({ODD_CHAT}, 1, 'assistant', '{ODD_TEXT}')
),
e AS (
  SELECT *, {sum(map(len, CONTROLS))} + length(role) + length(text)
    + coalesce(list_sum([length(m) + 1 for m in
        regexp_extract_all(role, '(\\*)({_CONTROL})', 1)]), 0)
    + coalesce(list_sum([length(m) + 1 for m in
        regexp_extract_all(text, '(\\*)({_CONTROL})', 1)]), 0) AS chars
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP8 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({_lower("text")}, '{WORD}'), []) AS words
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(words) < 2 THEN words
    ELSE [words[i] || ' ' || words[i + 1] for i in range(1, len(words))] END) AS shingle
  FROM d
),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL
),
l AS MATERIALIZED (
  SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 80 * (a.n + b.n - c)
),
reach AS (
  SELECT r AS x, r AS y FROM d UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x
),
g AS (SELECT x AS r, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = y GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS bigint) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM d JOIN g USING (r) LEFT JOIN n USING (r)
"""

# Windows are told apart by their digest, bytes handled as hexadecimal digits.
OP7 = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
),
w AS MATERIALIZED (
  SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m
  FROM (SELECT r, h, unnest(range(0, CAST(len(h) / 2 AS bigint) - 199)) AS i FROM d)
),
t AS MATERIALIZED (
  SELECT r, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)
),
e AS (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new
  FROM t
),
g AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS run FROM e),
runs AS MATERIALIZED (
  SELECT r, min(i) AS first, max(i) + 200 AS last FROM g GROUP BY r, run
),
gaps AS (
  SELECT r, coalesce(lag(last) OVER (PARTITION BY r ORDER BY first), 0) AS first, first AS last
  FROM runs
  UNION ALL SELECT r, max(last), NULL FROM runs GROUP BY r
),
left_ AS (
  SELECT r, string_agg(substr(h, 2 * first + 1,
    coalesce(2 * last, len(h)) - 2 * first), '' ORDER BY first) AS h
  FROM gaps JOIN d USING (r) GROUP BY r
),
n AS (SELECT r, sum(last - first) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, CAST(len(d.h) / 2 AS bigint) AS n_bytes,
  CAST(coalesce(n_removed, 0) AS bigint) AS n_removed, CAST(coalesce(n_spans, 0) AS bigint) AS n_spans,
  sha256(unhex(coalesce(left_.h, d.h))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN left_ USING (r)
"""

_FINITE = """embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""


def _codes(rounds: int = 6, entries: int = 16, parts: int = 8) -> str:
    """Codebooks of equal parts: rounds of nearest entries and rounded-down means."""
    near = """n{0} AS MATERIALIZED (
  SELECT v, part, arg_min(entry, distance * 16 + entry) AS entry,
    CAST(min(distance) AS bigint) AS distance
  FROM (SELECT p.v, p.part, b.entry,
      list_inner_product(p.x, p.x) + list_inner_product(b.x, b.x)
        - 2 * list_inner_product(p.x, b.x) AS distance
    FROM p JOIN b{0} AS b USING (part)) d
  GROUP BY v, part
)"""
    improved = """m{0} AS MATERIALIZED (
  SELECT part, entry, list(mean ORDER BY c) AS x
  FROM (SELECT n.part, n.entry, c, floor(sum(p.x[c]) / count(*)) AS mean
    FROM n{0} AS n JOIN p USING (v, part), unnest(range(1, len(p.x) + 1)) AS u(c)
    GROUP BY ALL) w
  GROUP BY part, entry
),
b{1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM b{0} AS b LEFT JOIN m{0} AS m USING (part, entry)
)"""
    steps = [near.format(0)]
    for k in range(rounds):
        steps += [improved.format(k, k + 1), near.format(k + 1)]
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE_CODES} * CAST(x AS double))) AS x
  FROM embeddings WHERE {_FINITE}
),
p AS MATERIALIZED (
  SELECT v, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] AS x
  FROM k, unnest(range({parts})) AS u(part)
),
b0 AS MATERIALIZED (SELECT part, v - 1 AS entry, x FROM p WHERE v <= {entries}),
{",".join(steps)},
h AS (
  SELECT sha256(string_agg(CAST(CAST(x[c] AS bigint) AS varchar), ','
    ORDER BY part, entry, c)) AS codebooks_sha256
  FROM b{rounds}, unnest(range(1, len(x) + 1)) AS u(c)
),
e AS (
  SELECT v, string_agg(printf('%02x', CAST(entry AS integer)), '' ORDER BY part) AS code,
    CAST(sum(distance) AS bigint) AS error
  FROM n{rounds} GROUP BY v
)
SELECT vec_id, label, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256
FROM e JOIN k USING (v), h
"""


OP11 = _codes()

_WHOLE_256 = f"""
WITH k AS MATERIALIZED (
  SELECT *, list_transform(embedding, lambda x: floor({SCALE_SEARCH} * CAST(x AS double))) AS x
  FROM embeddings WHERE {_FINITE} AND vec_id IS NOT NULL
)"""

OP12 = f"""{_WHOLE_256},
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS bigint) AS score
  FROM k q JOIN k c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

OP13 = f"""{_WHOLE_256},
l AS (
  SELECT vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM k WHERE label IS NOT NULL
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
    CAST(list_inner_product(a.x, c.x) AS bigint) AS score
  FROM l a JOIN l c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""

ORACLE = {
    "op2_warc_bundles": OP2,
    "op3_decontamination": OP3,
    "op7_repeated_strings": OP7,
    "op8_near_duplicates": OP8,
    "op9_chat_formatting": OP9,
    "op10_mixing": OP10,
    "op11_vector_codes": OP11,
    "op12_exact_search": OP12,
    "op13_hard_negatives": OP13,
}
