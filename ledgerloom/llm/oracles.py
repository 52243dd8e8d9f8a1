"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


SPACED_WORDS = r"[^\x20\x09-\x0D]+"
OP1_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{OP1_WORDS}') AS w FROM documents),
i AS (SELECT DISTINCT item_id, regexp_extract_all({lowered('text')}, '{OP1_WORDS}') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, n, p FROM dw JOIN iw USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
         FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM m WHERE item_id IS NOT NULL)
          GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{SPACED_WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(2, len(w)) - 1], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
           GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * i >= 80 * (na.n + nb.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM reach JOIN documents ON documents.doc_id = reach.a LEFT JOIN n USING (doc_id)
GROUP BY doc_id, n
"""


OP7 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(length(text), 0) AS chars, coalesce(len(regexp_extract_all(text, '{SPACED_WORDS}')), 0) AS size,
         coalesce(length(text) - length(translate(text, '#$%&*|', '')), 0) AS marks, text IS NULL AS empty
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || left(md5('mix:' || CAST(doc_id AS VARCHAR)), 13) AS BIGINT) + 1) / 4503599627370496.0)
         / CASE WHEN empty THEN 0.05::DOUBLE
                ELSE greatest(0.05::DOUBLE, 1 - 5 * (marks / greatest(chars, 1)::DOUBLE))
                     * (CASE WHEN chars BETWEEN 3 * size AND 12 * size THEN 1.0 ELSE 0.25 END)::DOUBLE END AS key
  FROM sized),
sizes AS (SELECT source, sum(size) AS size FROM sized GROUP BY source),
weighted AS (SELECT source, size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sizes),
filled AS (
  SELECT *, sum(size * 3) OVER w AS held, sum(weight) OVER w AS gone, row_number() OVER w AS k,
         lead(size * 3 / weight::DOUBLE) OVER w AS following
  FROM weighted WINDOW w AS (ORDER BY size * 3 / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
units AS (
  SELECT 0 AS k, (SELECT sum(size) FROM weighted)::DOUBLE / (SELECT sum(weight) FROM weighted) AS unit,
         (SELECT min(size * 3 / weight::DOUBLE) FROM weighted) AS following
  UNION ALL
  SELECT k, ((SELECT sum(size) FROM weighted) - held)::DOUBLE / nullif((SELECT sum(weight) FROM weighted) - gone, 0), following
  FROM filled),
chosen AS (SELECT unit FROM units WHERE unit IS NOT NULL AND unit <= following ORDER BY k LIMIT 1),
planned AS (SELECT source, size, least(unit * weight, (size * 3)::DOUBLE) AS target FROM weighted, chosen),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY key, doc_id) AS r FROM keyed),
walk AS (
  SELECT source, 0::BIGINT AS r, CASE WHEN size > 0 THEN target - floor(target / size) * size ELSE target END AS budget,
         0 AS drawn FROM planned
  UNION ALL
  SELECT w.source, k.r, CASE WHEN k.size <= w.budget THEN w.budget - k.size ELSE w.budget END,
         CASE WHEN k.size <= w.budget THEN 1 ELSE 0 END
  FROM walk w JOIN ranked k ON k.source IS NOT DISTINCT FROM w.source AND k.r = w.r + 1)
SELECT k.doc_id, k.size, p.size::BIGINT AS source_size, p.target,
       (k.size * least(CASE WHEN p.size > 0 THEN floor(p.target / p.size) ELSE 0 END + w.drawn, 3))::BIGINT AS taken
FROM ranked k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
JOIN walk w ON k.source IS NOT DISTINCT FROM w.source AND k.r = w.r
"""

OP13 = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
k AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM h),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": OP1,
    "op4_minhash_near_dedup": OP4,
    "op7_mixing_sources": OP7,
    "op13_fill_in_middle": OP13,
}
