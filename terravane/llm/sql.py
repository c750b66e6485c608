"""DuckDB SQL that gives the rows of the operator queries, where SQL can express them."""

from __future__ import annotations

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
tokens AS (
  SELECT row, unnest(w) AS w3, unnest(range(1, len(w) + 1)) AS pos, unnest(list_concat([NULL], w)[1:len(w)]) AS w2,
         unnest(list_concat([NULL, NULL], w)[1:len(w)]) AS w1 FROM docs),
grams AS (
  SELECT row, pos, w3 AS g1, CASE WHEN pos > 1 THEN w2 || ' ' || w3 END AS g2,
         CASE WHEN pos > 2 THEN w1 || ' ' || w2 || ' ' || w3 END AS g3 FROM tokens),
every AS (SELECT row, g1 AS g FROM grams UNION ALL SELECT row, g2 FROM grams WHERE pos > 1
          UNION ALL SELECT row, g3 FROM grams WHERE pos > 2),
own AS (SELECT row, g, count(*) AS n FROM every GROUP BY row, g),
others AS (SELECT row, g, sum(n) OVER (PARTITION BY g) - n AS n FROM own),
sizes AS (SELECT row, (SELECT sum(len(w)) FROM docs) - len(w) AS n FROM docs),
counted AS (
  SELECT t.row, t.pos, c1.n AS n1, coalesce(c2.n, 0) AS n2, coalesce(c3.n, 0) AS n3,
         lag(c1.n) OVER p AS b1, lag(c2.n) OVER p AS b2, s.n AS n
  FROM grams t JOIN sizes s USING (row) JOIN others c1 ON c1.row = t.row AND c1.g = t.g1
  LEFT JOIN others c2 ON c2.row = t.row AND c2.g = t.g2
  LEFT JOIN others c3 ON c3.row = t.row AND c3.g = t.g3
  WINDOW p AS (PARTITION BY t.row ORDER BY t.pos)),
scored AS (
  SELECT row, least(pos, 3) AS possible, CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 ELSE 1 END AS used,
         CASE WHEN n3 > 0 THEN n3 / b2 WHEN n2 > 0 THEN n2 / b1
              ELSE greatest(n1, 1) / greatest(n, 1) END AS share FROM counted),
summed AS (
  SELECT row, sum(CAST(round((ln(share) + (possible - used) * ln(0.4)) * 1000000) AS BIGINT)) AS log_micro,
         count(*) FILTER (used < possible) AS backed_off FROM scored GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(log_micro, 0)::BIGINT AS log_micro,
       CASE WHEN len(w) > 0 THEN log_micro / len(w) / 1000000 END AS mean_log,
       coalesce(backed_off, 0)::BIGINT AS backed_off
FROM docs LEFT JOIN summed USING (row)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format(_LOWER)} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM.format(_LOWER)} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM win),
spans AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT s.doc_id, s.i, s.n, w.item_id FROM spans s JOIN win w ON s.n = w.n AND s.g = w.g),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits)
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(CAST(doc_id AS VARCHAR)) AS k FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
level AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0)) / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
final AS (
  SELECT source, source_size, least(cap, weight * coalesce((SELECT level FROM level WHERE cap > level * weight
         ORDER BY cap / weight LIMIT 1), 'inf')) AS target FROM level),
placed AS (
  SELECT d.*, f.source_size, f.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM d JOIN final f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE size * (floor(target)::BIGINT // source_size)
        + greatest(0, least(size, floor(target)::BIGINT % source_size - begin)) END)::BIGINT AS taken
FROM placed
"""

OP10 = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l, text FROM documents),
win AS (
  SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS g
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win)
  WHERE r > 1),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again)
  GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p, gone FROM d JOIN gone USING (doc_id))
  WHERE NOT list_contains(gone, p) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(l) END::BIGINT AS n_lines,
       coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN d.text ELSE coalesce(kept.text, '') END) AS text_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

def _assigned(n: int) -> str:
    """Every vector with its nearest centroid of c{n}."""
    return f"""
a{n} AS (
  SELECT row, min({{'d': norm - 2 * list_inner_product(x, c)::BIGINT + list_inner_product(c, c)::BIGINT, 'c': k}}) AS m
  FROM kept CROSS JOIN c{n} GROUP BY row)"""


def _moved(n: int) -> str:
    """Centroids c{n + 1} after the assignment a{n}."""
    return f"""
s{n} AS (
  SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT a.m.c AS k, unnest(x)::BIGINT AS x, unnest(range(64)) AS i FROM a{n} a JOIN kept USING (row))
  GROUP BY k, i),
f{n} AS (SELECT k, list(((s - ((s % n + n) % n)) // n)::DOUBLE ORDER BY i) AS c FROM s{n} GROUP BY k),
c{n + 1} AS (SELECT k, coalesce(f.c, c{n}.c) AS c FROM c{n} LEFT JOIN f{n} f USING (k))"""


OP11 = f"""
WITH kept AS (
  SELECT *, list_inner_product(x, x)::BIGINT AS norm FROM (
    SELECT row_number() OVER () AS row, vec_id, [floor(64 * e::DOUBLE) FOR e IN embedding] AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0)),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x AS c
  FROM (SELECT sha256('1:' || vec_id) AS h, x FROM kept ORDER BY h, x LIMIT 16)),
{_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)}, {_moved(2)}, {_assigned(3)},
done AS (SELECT vec_id, m.c::INTEGER AS cluster, m.d::BIGINT AS distance FROM a3 JOIN kept USING (row))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string([e::BIGINT::VARCHAR FOR e IN c], ',')) AS centroid_sha256
FROM done JOIN c3 ON c3.k = done.cluster
"""

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
f AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS n FROM grams
      GROUP BY lang, size, phrase HAVING count(*) >= 30),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(n) AS more
  FROM (SELECT lang, w, n, m, unnest(range(1, size - m + 2)) AS i
        FROM f, (SELECT unnest([2, 3]) AS m) WHERE m < size) GROUP BY ALL),
cuts AS (
  SELECT f.lang, f.phrase, f.n AS a, f.size, f.w, unnest(range(1, f.size)) AS k
  FROM f LEFT JOIN inside USING (lang, phrase) WHERE f.size > 1 AND (more IS NULL OR 100 * more < 80 * f.n)),
scored AS (
  SELECT c.lang, c.phrase, a, k, l.n AS l, r.n AS r, ((2000000::HUGEINT * a) // (l.n + r.n))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS first FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
  WHERE first = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_lm_score": OP1,
    "op4_decontamination": OP4,
    "op5_mixing": OP5,
    "op10_line_dedup": OP10,
    "op11_centroids": OP11,
    "op13_collocations": OP13,
}
