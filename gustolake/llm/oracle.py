"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

# The 32 letters of a base-32 digest, each from five bits of the hexadecimal one (five digits hold four letters).
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(sha1_hex, {5 * (i // 4) + 1}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31)::INTEGER, 1)"
    for i in range(32)
)

NEAREST = """
WITH usable AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
      AND isfinite(list_sum(embedding::DOUBLE[])) AND (list_min(embedding) <> 0 OR list_max(embedding) <> 0)
), same_length AS (
    SELECT vec_id, v FROM usable
    WHERE len(v) = (SELECT len(v) FROM usable GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_distance(q.v, c.v) AS score,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, c.v), c.vec_id) AS n
    FROM same_length q JOIN same_length c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 10
"""

WARC = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), decided AS (
    SELECT page_id, payload, sha1(payload) AS sha1_hex, max(page_id) OVER (PARTITION BY payload) AS latest FROM payloads
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN latest IS NULL OR page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM decided
"""

FILTER_INTERACTIONS = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
    FROM documents
), failed AS (
    SELECT part, {
             'A': len(words) < 100,
             'B': 100 * len(list_distinct(words)) < 80 * len(words),
             'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
             'D': regexp_matches(t, '[#$%&*|]'),
             'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f,
           coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
           coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
    FROM texts
), by_filter AS (
    SELECT part, good, toxic, map {'A': f.A, 'B': f.B, 'C': f.C, 'D': f.D, 'E': f.E} AS fails,
           f.A::INT + f.B::INT + f.C::INT + f.D::INT + f.E::INT AS n_fails
    FROM failed
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
    JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), placed AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS own, string_split(filter_order[:step - 1], '') AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), judged AS (
    SELECT part, filter_order, step, own, good, toxic, n_fails, fails[own] AS fails_own,
           len([x FOR x IN earlier IF x <> '' AND fails[x]]) > 0 AS gone
    FROM by_filter, placed
), counted AS (
    SELECT part, filter_order, step, own,
           count(*) FILTER (NOT gone AND NOT fails_own) AS kept,
           count(*) FILTER (NOT gone AND fails_own) AS removed,
           count(*) FILTER (gone AND fails_own) AS redundant,
           count(*) FILTER (fails_own AND n_fails = 1) AS unique_fails,
           count(*) FILTER (NOT gone AND fails_own AND good) AS good_lost,
           count(*) FILTER (NOT gone AND fails_own AND toxic) AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counted
"""

ORACLE_SQL: dict[str, str] = {"op3_nearest_neighbours": NEAREST, "op4_warc_round_trip": WARC, "op12_filter_interactions": FILTER_INTERACTIONS}
